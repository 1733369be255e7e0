"""PySpark jobs for moving legacy tables: blob export and address cleaning.

``lading.plans`` holds the jobs, ``lading.operators`` the DataFrame
transformations they are made of, ``lading.functions`` the Column helpers and
``lading.sources`` the table schemas and the one-file-per-row sink.
"""
