"""Registered queries and the SQL they are checked against.

The test tables play the clinical tables through the adapters; nothing here is needed by a user of the
``morbidity`` package.
"""
