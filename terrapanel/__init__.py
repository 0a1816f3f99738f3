"""terrapanel — panel and seasonal-series analytics on Spark DataFrames.

Station-day readings are cleaned, rolled up to country/year and month, joined
with yearly indicators, and analysed with grouped statistics, ridge and OLS
regressions, and seasonal forecasts.  Every operator is a function
``DataFrame -> DataFrame`` (usable with ``df.transform``); only result-sized
statistics ever reach the driver.
"""

__version__ = "0.1.0"
