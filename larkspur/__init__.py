"""Dataset curation and evaluation as Spark DataFrame jobs.

Every operator takes DataFrames and parameters and returns a DataFrame. Only
the writers, the probe trainer, the round driver and the streams run actions.
"""
