"""faro: applied data analysis on Spark DataFrames.

Profiling, wrangling, leak-free resampling, fitted preprocessing, models,
metrics, tuning, clustering/PCA, text analysis, annotation batches and
group-fairness audits, each expressed as DataFrame -> DataFrame operators.
"""

__version__ = "0.1.0"
