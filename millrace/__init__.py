"""PySpark-native feature engineering and data quality: DataFrame in, DataFrame out."""
