"""tidecast: forecasting and comparing large collections of daily series on Spark."""
