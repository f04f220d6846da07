"""ledgerloom -- layered transaction analytics as Spark DataFrame operators.

Bronze (land raw files with audit columns and batch lineage) -> Silver (typed,
de-duplicated, calendar and pay-cycle flags) -> Gold (customer-month summary,
lifetime profile) -> insight reports, quality profiles and behavioural signals.
Every operator is a function from DataFrame(s) to DataFrame over built-in
Spark expressions; nothing triggers a job unless its name says it writes.
"""

__version__ = "0.1.0"
