"""percepta: tabular classification on Spark.

Read CSV or Parquet tables, encode categories, impute, standardize and
one-hot encode into feature vectors, split, train and cross-validate
multilayer-perceptron classifiers, report metrics and score new rows --
all as native Spark column expressions and Spark ML stages.
"""

__version__ = "0.1.0"
