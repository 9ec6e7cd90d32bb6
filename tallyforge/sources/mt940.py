"""MT940 bank statements: a reader of :61:/:86: lines in built-in functions, and a writer.

A file is cut into records at its :61: tags by the text reader, so a large file is read by many tasks; a record holds one statement line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import refuse_pans
from ..schemas import STATEMENT

# One statement line with its narration, its parts, and the links to transactions.
ENTRY = r"(?m)^:61:[^\r\n]*(?:\r?\n(?!:)[^\r\n]*)*(?:\r?\n:86:[^\r\n]*(?:\r?\n(?![:-])[^\r\n]*)*)?"
LINE = r"^:61:(\d{6})(?:\d{4})?([Rr]?[CDcd])[A-Za-z]?(\d+(?:,\d*)?)(?:[A-Z][A-Z0-9]{3})?([^\r\n/]*)(?://([^\r\n]*))?"
TAG_86 = r"(?s):86:(.*)$"
TXN_LINK, RECON_LINK = r"TXN\d{6,}", r"ReconRef (\d{6,})"


class StatementError(ValueError):
    """A statement file that must not be used."""


def parse_text(content: Column) -> Column:
    """array of statement line texts."""
    return F.regexp_extract_all(content, F.lit(ENTRY), F.lit(0))


def parse_entry(entry: Column) -> dict[str, Column]:
    """The statement columns of one line: debits and reversed credits are negative, marks in any case."""
    part = lambda i: F.regexp_extract(entry, LINE, i)
    size = F.round(F.replace(part(3), F.lit(","), F.lit(".")).try_cast("decimal(38,10)") * 100, 0).cast("long")
    amount = F.when(F.upper(part(2)).isin("D", "RC"), -size).otherwise(size)
    day = F.try_to_date(F.concat(F.lit("20"), part(1)), "yyyyMMdd")
    narration = F.trim(F.regexp_replace(F.regexp_extract(entry, TAG_86, 1), r"\s*\r?\n\s*", " "))
    link = F.coalesce(F.nullif(F.regexp_extract(narration, TXN_LINK, 0), F.lit("")), F.nullif(F.regexp_extract(narration, RECON_LINK, 1), F.lit("")))
    return {
        "bank_ref": F.coalesce(F.nullif(F.trim(part(4)), F.lit("")), F.trim(part(5))), "amount_paise": amount, "value_date": F.date_format(day, "yyyy-MM-dd"),
        "direction": F.when(amount >= 0, "CREDIT").otherwise("DEBIT"), "link_tx": link, "narration": F.substring(narration, 1, 256),
    }


def parse(files: DataFrame) -> DataFrame:
    """(path, the statement columns) of files with path and value columns."""
    entries = files.select("path", F.explode(parse_text(F.col("value"))).alias("entry"))
    return entries.select("path", *(c.cast(STATEMENT[n].dataType).alias(n) for n, c in parse_entry(F.col("entry")).items()))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, entry): the statement lines of all files at path, null for the part of a file that stands before its first line.

    What follows a :61: tag is a line even if it makes no sense; a file's head begins with another tag or an envelope.
    """
    cut = spark.read.option("lineSep", "\n:61:").text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    whole = F.when(F.col("value").startswith(":61:"), F.col("value")).otherwise(F.concat(F.lit(":61:"), F.col("value")))
    head = F.col("value").rlike(r"^\s*[:{]") & ~F.col("value").startswith(":61:")
    return cut.select("path", F.when(~head, F.regexp_extract(whole, ENTRY, 0)).alias("entry"))


def _empty_files(spark: SparkSession, path: str) -> list[str]:
    """The files at path without a byte, which no reader sees."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for top in fs.globStatus(at) or [] for s in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
    return [s.getPath().toString() for s in found if s.isFile() and s.getLen() == 0 and not s.getPath().getName().startswith(("_", "."))]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The statements of all files at path. A file without lines, a line without a date or amount, or a card number refuses all."""
    cut = records(spark, path)
    lines_of = cut.groupBy("path").agg(F.count("entry").alias("n"))
    none = _empty_files(spark, path)[:3] or [r["path"] for r in lines_of.where("n = 0").limit(3).collect()]
    if none:
        raise StatementError(f"no statement lines in {none}")
    rows = cut.where("entry IS NOT NULL").select(*(c.cast(STATEMENT[n].dataType).alias(n) for n, c in parse_entry(F.col("entry")).items()))
    if rows.where(F.col("value_date").isNull() | F.col("amount_paise").isNull()).limit(1).count():
        raise StatementError(f"a statement line in {path} has no date or no amount")
    refuse_pans(rows)
    return rows


def lines(settlements: DataFrame) -> DataFrame:
    """(transaction_id, line): the two text lines of each positive settlement, linked by its digits."""
    amount = F.col("settled_amount_paise")
    rupees = F.concat(F.call_function("div", amount, F.lit(100).cast("long")).cast("string"), F.lit(","), F.lpad((amount % 100).cast("string"), 2, "0"))
    digits = F.regexp_replace("transaction_id", "[^0-9]", "")
    day = F.date_format(F.try_to_date(F.col("settlement_date"), "yyyy-MM-dd"), "yyMMdd")
    line = F.concat(F.lit(":61:"), day, F.lit("C"), rupees, F.lit("NTRF"), F.substring("bank_ref_id", 1, 16), F.lit("\n:86:ReconRef "), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0")))
    return settlements.where((amount > 0) & day.isNotNull()).select("transaction_id", "settled_amount_paise", line.alias("line"))


def write(settlements: DataFrame, path: str, account: str = "TALLYFORGE", files: int = 1) -> None:
    """Statement files with an opening line, the settlements' lines by transaction and the closing balance of each file.

    A settlement's file follows from its transaction. Only the sums of the files are gathered; the lines are sorted where
    their file is written and stream into it one by one.
    """
    body = lines(settlements).select(F.pmod(F.xxhash64("transaction_id"), F.lit(files)).cast("int").alias("p"), F.lit(1).alias("part"), "transaction_id", "line", "settled_amount_paise")
    sums = body.groupBy("p").agg(F.sum("settled_amount_paise").alias("s"))
    total = F.concat(F.call_function("div", F.col("s"), F.lit(100).cast("long")).cast("string"), F.lit(","), F.lpad((F.col("s") % 100).cast("string"), 2, "0"))
    frame = lambda part, text: sums.select("p", F.lit(part).alias("part"), F.lit("").alias("transaction_id"), text.alias("line"))
    head, foot = F.lit(f":20:STATEMENT\n:25:{account}\n:28C:1/1\n:60F:C000101INR0,00"), F.concat(F.lit(":62F:C000101INR"), total)
    rows = body.drop("settled_amount_paise").unionByName(frame(0, head)).unionByName(frame(2, foot))
    rows.repartitionById(files, "p").sortWithinPartitions("part", "transaction_id").select("line").write.mode("overwrite").text(path)
