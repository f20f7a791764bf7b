"""phasemill: a PySpark-native engine for labelled motion time series and corpus preparation."""
