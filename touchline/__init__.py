"""touchline: a layered football-data pipeline on Spark DataFrames and Structured Streaming.

Raw messages land in a Bronze table (streaming append), are parsed and flattened into
Silver tables, and are summarised into Gold analytics. Every operator is a lazy
``DataFrame -> DataFrame`` function; only ``sinks``, ``streaming`` and ``plans`` act.
"""

__version__ = "0.1.0"
