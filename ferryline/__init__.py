"""ferryline: change-data pipelines (delimited text lines and JSON change
envelopes into typed tables) written as plain PySpark DataFrame code.

Every operator is a ``DataFrame -> DataFrame`` function built from native
column expressions, so the same code runs on batch and streaming input.
"""

__version__ = "0.1.0"
