"""marketprep: Spark-native preparation of market and energy report tables.

Report texts and JSON record sets become typed, keyed tables; settlement
prices and refinery utilization are computed over whole date histories as
DataFrame plans (no Python UDFs, no custom Catalyst rules).
"""

__version__ = "0.1.0"
