"""Mail-shaped inputs derived from the given tables, by expressions that grow with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import schemas
from postmill.functions import dates, text
from postmill.operators import sentiment
from postmill.plans import mail_import

DOMAIN = "corp.example.com"
OTHER_DOMAIN = "partner.example.org"

# A small lexicon of words that are frequent in the given texts.
LEXICON = [
    ("the", 2.0),
    ("and", -1.0),
    ("that", 3.0),
    ("with", -2.0),
    ("was", -3.0),
    ("for", 1.0),
    ("are", -4.0),
    ("from", 4.0),
    ("of", -2.0),
]
STOP_WORDS = ["the", "and", "with"]

# A date in year 1, and its instant as the Java platform reads it.
SHORT_YEAR = "Mon, 14 May 01 16:39:00 -0700"
SHORT_YEAR_MILLIS = -62_124_193_260_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, schemas.LEXICON)


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per document; the last of every ten repeats the key of the first."""
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id as seq", "case when doc_id % 10 = 9 then doc_id - 9 else doc_id end as kk", "text as body"
    )
    return docs.selectExpr(
        "seq",
        """concat('user', string(kk % 37),
             case when (kk % 37) % 3 = 0 then '@partner.example.org' else '@corp.example.com' end) as sender""",
        "915148800000 + ((kk * 7919) % 1460) * 86400000 + (kk % 86400) * 1000 as ts",
        """case when seq % 10 = 9 then null
                when seq % 5 = 0 then concat('user', string((seq * 7 + 3) % 11), '@corp.example.com, USER',
                                             string((seq * 11 + 5) % 13), '@Corp.example.com,')
                else concat('user', string((seq * 7 + 3) % 11), '@corp.example.com') end as recipients""",
        "case when seq % 13 != 0 then concat('Subject ', string(seq)) end as subject",
        "case when seq % 4 = 0 then 'cc@corp.example.com' end as x_cc",
        "case when seq % 8 = 0 then 'bcc@corp.example.com' end as x_bcc",
        "body",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as parsed rows."""
    return mail(spark, sf_dir).select(
        F.col("seq").alias("path"),
        F.col("sender").alias("from"),
        "ts",
        F.concat(F.lit("m"), F.col("seq").cast("string")).alias("mid"),
        F.col("recipients").alias("to"),
        "subject",
        F.coalesce("x_bcc", "x_cc").alias("cc"),
        F.lit(None).cast("string").alias("bcc"),
        text.clean_body(F.concat(F.lit("\n"), "body", F.lit("\n"))).alias("body"),
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_import.merge_messages(messages(spark, sf_dir), "emails")


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_import.merge_messages(messages(spark, sf_dir), "employee")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.score_messages(emails(spark, sf_dir), lexicon(spark), ["from", "ts"])


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as raw text, ``(path, value)``, with some broken headers.

    Of every 101 messages one lacks its date, one has a date without zone name,
    one lacks its id, one has an empty id and one lacks its sender; some have
    Windows line ends, a repeated or a wrapped header.  Some dates are lenient: the
    hour runs over into the next day, all of the clock is in the seconds, the offset
    is a name, or the year has two digits (``SHORT_YEAR``).
    """
    m = mail(spark, sf_dir)
    seq = F.col("seq")
    kind = seq % 101

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\n")), F.lit(""))

    day = F.date_format(dates.utc_date(F.col("ts")), "EEE, dd MMM yyyy")
    second = F.pmod(F.floor(F.col("ts") / 1000), F.lit(86400))
    clock = F.format_string(
        "%02d:%02d:%02d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60
    )
    late = F.concat_ws(
        " ",
        F.date_format(F.date_sub(dates.utc_date(F.col("ts")), 1), "EEE, dd MMM yyyy"),
        F.format_string("%02d:%02d:%02d", F.floor(second / 3600) + 24, F.floor(second / 60) % 60, second % 60),
        F.lit("+0000"),
    )
    stamp = (
        F.when(kind == 6, late)
        .when(kind == 7, F.concat_ws(" ", day, F.format_string("0:0:%d", second), F.lit("+0000")))
        .when(kind == 8, F.lit(SHORT_YEAR))
        .when(kind == 9, F.concat_ws(" ", day, clock, F.lit("GMT")))
        .otherwise(F.concat_ws(" ", day, clock, F.lit("+0000")))
    )
    head = F.concat(
        F.when(kind == 3, "").when(kind == 5, "Message-ID: <>\n").otherwise(
            line("Message-ID", F.concat(F.lit("<m"), seq.cast("string"), F.lit("x>")))
        ),
        F.when(kind == 1, "").when(kind == 2, line("Date", stamp)).otherwise(
            line("Date", F.concat(stamp, F.lit(" (UTC)")))
        ),
        F.when(kind == 4, "").otherwise(line("From", F.col("sender"))),
        F.when(seq % 6 == 0, "To: \n").otherwise(""),
        line("To", F.col("recipients")),
        F.when(
            (seq % 7 == 0) & F.col("recipients").isNotNull(),
            "\tlate@corp.example.com\nTo: other@corp.example.com\n",
        ).otherwise(""),
        line("Subject", F.col("subject")),
        line("X-cc", F.col("x_cc")),
        line("X-bcc", F.col("x_bcc")),
    )
    whole = F.concat(head, F.lit("\n"), F.col("body"), F.lit("\n"))
    return m.select(
        F.concat(F.lit("inbox/"), F.lpad(seq.cast("string"), 15, "0")).alias("path"),
        F.when(seq % 3 == 0, F.replace(whole, F.lit("\n"), F.lit("\r\n"))).otherwise(whole).alias("value"),
    )
