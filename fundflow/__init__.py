"""fundflow: a Spark-native engine for apportioning incentive losses over funds.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins, so one plan runs the same on a laptop sample and on a cluster.

Subpackages
-----------
functions  column expressions (cleaning, recoding, labels, text formats)
sources    readers: by-name multi-file CSV, typed scans, bad-line skipping, audits
operators  relational building blocks: rates/apportion, reshape, aggregates,
           outer combine / reconcile, trends, sinks
plans      composite jobs (fund summary, combined loss, reports, trends) and the
           query registry over the driver's tables
streaming  the same fund summary over a stream of arriving yearly files
"""

__version__ = "0.1.0"
