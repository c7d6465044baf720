"""farelens: a Spark-native trip-fare study.

Typed trip scans, key deduplication, data-quality reports, calendar and
great-circle features, column profiles (missing values, moments, quantiles,
outliers, histograms, heatmaps, correlations), MLlib regression fits and
tuning, and prediction-error analysis. Every operator is a function from
DataFrame to DataFrame; none creates a session or gathers rows on the driver.
"""

from .params import DEFAULT, Params

__all__ = ["DEFAULT", "Params"]
