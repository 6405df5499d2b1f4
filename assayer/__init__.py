"""assayer: score datasets, grade them gold / silver / bronze / rejected, and keep the evidence.

Everything is a Spark job: operators take and return DataFrames, scores of a dataset come
from one aggregate scan, and streams are graded per micro-batch.
"""

__version__ = "0.1.0"
