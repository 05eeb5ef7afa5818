"""Entity pipelines, one module per source system.

A module holds ``SCHEMAS`` (payload name -> DDL of its records; every field may be NULL) and
``ENTITIES`` (refined table name -> ``Entity``). Payload fields and refined columns carry the
names their owners gave them.
"""
