"""Article-recommendation data work on PySpark.

Tables of impressions, click histories and articles go in; labelled and sampled
training lists, encoded text, user and article vectors, scores, ranks, metrics
and prediction files come out.  Every step is a DataFrame job.
"""
