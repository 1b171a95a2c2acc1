"""CSV files of records: quoted where a field needs it, quotes doubled, nothing trimmed, empty for null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.plans.specs import OfficeSpec, ResumeSpec

OPTIONS = {"header": False, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "encoding": "UTF-8"}
PERSONAL = ("mobile_number", "address", "email")


def write(records: DataFrame, spec: OfficeSpec, path: str, resume: ResumeSpec | None = None, ordered: bool = False, redact: bool = False) -> None:
    """Writes the office's columns to path, a folder of CSV files. A fresh run replaces what is there and begins
    with the header, a line in a first file of its own; one that resumes below the post appends without a
    header, and so repeats rows of the leaf it starts at. The files of a run in the order of their names are
    one CSV file.

    ordered: in page order through all files, each task sorting a range of it. redact: empties the fields that
    hold personal data.
    """
    fresh = (resume or ResumeSpec()).fresh
    out = records.orderBy("path", "page_no", "row_ord") if ordered else records
    out = out.select(*[F.lit("").alias(c) if redact and c in PERSONAL else F.col(c).cast("string").alias(c) for c in spec.columns])
    if fresh:
        out = records.sparkSession.createDataFrame([spec.columns], spec.schema).coalesce(1).union(out)
    out.write.options(**OPTIONS).mode("overwrite" if fresh else "append").csv(path)


def read(spark: SparkSession, spec: OfficeSpec, path: str) -> DataFrame:
    """Records as written, without the header; an empty field is the empty string, which it may have been null before."""
    got = spark.read.schema(spec.schema).options(**OPTIONS, multiLine=True).csv(path)
    header = F.lit(True)
    for c in spec.columns:
        header = header & F.col(c).eqNullSafe(F.lit(c))
    return got.where(~header).select(*[F.coalesce(c, F.lit("")).alias(c) for c in spec.columns])
