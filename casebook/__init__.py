"""Case-record analytics on Spark: plain DataFrame operators plus ML stages."""
