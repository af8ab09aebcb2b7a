"""One entry per question or operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import schemas
from postmill.functions import dates, text
from postmill.operators import asof, counting, messages, postings, sentiment, term_deltas, terms, versions
from postmill.plans import heavy, keywords, mail_import, reports
from postmill.session import scratch_folder
from postmill.sinks import bucketed
from postmill.sources import ledger, tables, views
from registered import inputs

KEYS = ["from", "ts"]
CONVERSATION_KEYS = ["conv_id"]
#: Buckets of the stored table at least; of larger tables one holds so many messages.
BUCKETS = 64
BUCKET_ROWS = 20_000
#: Events of one user that stay together; users of more are cut into time slices.
AS_OF_SLICE = 100_000
EVENT_TYPES = ["click", "error", "purchase"]


# --- questions over the stored tables ---------------------------------------


def top_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_senders(inputs.emails(spark, sf_dir))


def top_senders_by_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_senders_by_versions(inputs.employee(spark, sf_dir))


def top_correspondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_correspondents(inputs.emails(spark, sf_dir))


def top_correspondents_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs from a sketch's candidates, proven by its error bound."""
    pairs = reports.correspondent_pairs(inputs.emails(spark, sf_dir))
    return heavy.top_counts(pairs, ["sender", "recipient"], reports.TOP, "email_count")


def top_correspondents_by_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_correspondents_by_versions(inputs.employee(spark, sf_dir))


def correspondent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.correspondent_counts(inputs.emails(spark, sf_dir))


def correspondent_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.correspondent_version_counts(inputs.employee(spark, sf_dir))


def weekly_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = reports.weekly_sentiment(inputs.scored(spark, sf_dir), inputs.DOMAIN)
    return weeks.select(
        "weeknum",
        F.round("avgsentiment", 6).alias("avgsentiment"),
        F.round("stddevsentiment", 6).alias("stddevsentiment"),
        "nummessages",
    )


def weekly_event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = reports.weekly_statistics(
        inputs.table(spark, sf_dir, "events"), F.to_date("ts"), "value", base_year=2024
    )
    return weeks.select(
        "weeknum",
        F.round("avgsentiment", 4).alias("avgvalue"),
        F.round("stddevsentiment", 4).alias("stddevvalue"),
        F.col("nummessages").alias("numevents"),
    )


def weekly_event_values_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored states of several loads, one for each type of event."""
    events = inputs.table(spark, sf_dir, "events")
    path = scratch_folder(spark)
    # Each load would append its own states; here they are made side by side.
    states = [
        reports.week_states(events.where(F.col("event_type").eqNullSafe(kind)), F.to_date("ts"), "value", base_year=2024)
        for kind in EVENT_TYPES
    ]
    others = events.where(~F.coalesce(F.col("event_type").isin(EVENT_TYPES), F.lit(False)))
    for state in [*states, reports.week_states(others, F.to_date("ts"), "value", base_year=2024)]:
        state.write.mode("append").parquet(path)
    weeks = reports.state_statistics(reports.merge_states(spark.read.parquet(path)))
    return weeks.select(
        "weeknum",
        F.round("avgsentiment", 4).alias("avgvalue"),
        F.round("stddevsentiment", 4).alias("stddevvalue"),
        F.col("nummessages").alias("numevents"),
    )


def words_by_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = reports.words_by_sentiment(inputs.scored(spark, sf_dir), inputs.DOMAIN)
    return words.select("word", F.round("totalsentiment", 6).alias("totalsentiment"))


def words_by_sentiment_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for two domains, from one stored index of posting lists that keeps the scores."""
    path = scratch_folder(spark)
    postings.write_index(inputs.scored(spark, sf_dir), path, ("sentiment",))
    parts = [
        postings.word_totals(spark, path, None, domain).select(
            F.lit(domain).alias("domain"), "word", F.round("totalsentiment", 6).alias("totalsentiment")
        )
        for domain in (inputs.DOMAIN, inputs.OTHER_DOMAIN)
    ]
    return parts[0].unionByName(parts[1])


def message_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.scored(spark, sf_dir).select("from", "ts", "sentiment")


def message_sentiment_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = sentiment.score_messages_by_join(
        inputs.emails(spark, sf_dir).select(*KEYS, "body"), inputs.lexicon(spark), KEYS
    )
    return scored.select("from", "ts", "sentiment")


def message_sentiment_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the lexicon treated as too large for a broadcast: a bit filter and a merge join."""
    scored = sentiment.score_messages_by_join(
        inputs.emails(spark, sf_dir).select(*KEYS, "body"), inputs.lexicon(spark), KEYS, broadcast_chars=0
    )
    return scored.select("from", "ts", "sentiment")


def sentiment_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.sentiment_cells(inputs.scored(spark, sf_dir), KEYS, F.lit(1_000_000_000_000))


# --- keywords ------------------------------------------------------------------


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_counts(inputs.emails(spark, sf_dir), KEYS, "body", inputs.STOP_WORDS)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and counts of each message, stored: the texts are cleaned, merged and split once."""
    path = scratch_folder(spark)
    terms.message_runs(inputs.emails(spark, sf_dir), KEYS, "body", inputs.STOP_WORDS).write.parquet(path)
    return spark.read.parquet(path)


def message_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = keywords.keywords_of_runs(_runs(spark, sf_dir))
    return best.select("doc", "word", F.round("score", 6).alias("score"))


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def raw_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of texts that have not been cleaned, with tabs and line ends of two kinds."""
    raw = F.replace(F.replace("text", F.lit(", "), F.lit(",\t")), F.lit(".\n"), F.lit(".\r\n \x01"))
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", raw.alias("body"))
    return terms.term_counts(docs, ["doc_id"], "body", inputs.STOP_WORDS)


def row_normalised_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows named by text, some of them null or blank."""
    name = F.when(F.col("user_id") % 7 == 0, F.lit(None)).when(F.col("user_id") % 7 == 1, F.lit(" "))
    events = inputs.table(spark, sf_dir, "events")
    matrix = events.select(name.otherwise(F.col("event_type")).alias("row"), F.col("event_id").alias("col"), "value")
    shares = terms.row_l1_normalise(matrix, "row")
    return shares.select("row", "col", F.round(F.col("value") * 1e6, 4).alias("value"))


def term_counts_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop words as a table: here the event types and region names of the given tables, lower case."""
    names = inputs.table(spark, sf_dir, "events").select(F.lower("event_type").alias("word"))
    regions = inputs.table(spark, sf_dir, "region").select(F.lower("r_name").alias("word"))
    frequent = inputs.lexicon(spark).select("word")
    stop = names.union(regions).union(frequent)
    return terms.term_counts(inputs.emails(spark, sf_dir), KEYS, "body", stop)


def _frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.message_frequency(inputs.emails(spark, sf_dir), "body", inputs.STOP_WORDS)


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frequency(spark, sf_dir)


def document_frequency_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.document_frequency(_counts(spark, sf_dir))


def inverse_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    idf = terms.inverse_document_frequency(_frequency(spark, sf_dir))
    return idf.select("word", F.round("idf", 6).alias("idf"))


def word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole scored matrix, before the cut to the best words."""
    counts = terms.counts_of_runs(_runs(spark, sf_dir), KEYS)
    scores = terms.word_scores(counts, terms.document_frequency(counts), KEYS)
    return scores.select("from", "ts", "word", F.round("score", 6).alias("score"))


def row_normalised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = inputs.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("row"), F.col("event_id").alias("col"), "value"
    )
    shares = terms.row_l1_normalise(matrix, "row")
    return shares.select("row", "col", F.round("value", 6).alias("value"))


def message_keywords_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best words from all term counts, none left out by bounds."""
    best = keywords.keywords_of_counts(_counts(spark, sf_dir))
    return best.select("doc", "word", F.round("score", 6).alias("score"))


def document_frequency_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies after a second load, from those of the first and the signed change.

    The load gives every fourth second's messages a longer body, leaves other bodies as
    they are, and brings replies under new keys.
    """
    stored = inputs.emails(spark, sf_dir).select(*KEYS, "body", "subject")
    path = scratch_folder(spark)
    term_deltas.append_delta(terms.message_frequency(stored, "body", inputs.STOP_WORDS), path, 1)
    again = F.when(F.col("ts") % 4000 == 0, F.concat("body", F.lit(" seen again")))
    load = stored.select(*KEYS, again.alias("body"))
    replies = stored.where("subject is not null").select(
        F.concat(F.lit("re-"), "from").alias("from"), "ts", F.concat(F.lit("late reply "), "subject").alias("body")
    )
    delta = term_deltas.frequency_delta(stored, load.unionByName(replies), KEYS, "body", inputs.STOP_WORDS)
    term_deltas.append_delta(delta, path, 2)
    return term_deltas.read_frequency(spark, path)


# --- import -------------------------------------------------------------------


def _imported(spark: SparkSession, sf_dir: str, target: str, profile: str) -> DataFrame:
    table, _ = mail_import.import_messages(inputs.raw_messages(spark, sf_dir), target, profile)
    return table


def imported_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir, "emails", messages.REFERENCE)


def imported_emails_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir, "emails", messages.INTENDED)


def imported_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of all columns, one row per cell; dates as text."""
    table = _imported(spark, sf_dir, "employee", messages.REFERENCE)
    table = table.withColumn("date", F.col("date").cast("string"))
    return versions.all_versions(table, ["employee"], "ts", ["mid", "date", "from", "to", "subject", "cc", "body"])


def import_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = mail_import.import_messages(inputs.raw_messages(spark, sf_dir))
    return rejects


def import_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.import_tally(messages.parse_messages(inputs.raw_messages(spark, sf_dir)))


def clean_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_body(F.col("text")).alias("body"))


def upserted_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.emails(spark, sf_dir)


def _load_again(stored: DataFrame) -> DataFrame:
    """A second load, with new subjects and without recipients."""
    return stored.select(
        *KEYS,
        F.concat("mid", F.lit("-again")).alias("mid"),
        "date",
        F.lit(None).cast("string").alias("to"),
        F.when(F.col("ts") % 2000 == 0, "seen again").alias("subject"),
        "cc",
        "bcc",
        "body",
    )


def merged_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load merged into the stored table."""
    stored = inputs.emails(spark, sf_dir)
    columns = ["mid", "date", "to", "subject", "cc", "bcc", "body"]
    return versions.merge_into(stored, _load_again(stored), KEYS, columns)


def upserted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the table stored in hash buckets, of which the load rewrites its own."""
    path = scratch_folder(spark)
    buckets = max(BUCKETS, -(-inputs.table(spark, sf_dir, "documents").count() // BUCKET_ROWS))
    bucketed.write_buckets(inputs.emails(spark, sf_dir), path, KEYS, buckets)
    bucketed.upsert_buckets(_load_again(bucketed.read_buckets(spark, path)), path)
    return bucketed.read_buckets(spark, path)


def import_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two imports of one folder: of the second, only new and changed files are opened.

    The first finds the messages without recipients missing; before the second, those
    with a cc grow by a line.
    """
    raw = inputs.raw_messages(spark, sf_dir)
    listed = raw.select("path", F.octet_length("value").cast("bigint").alias("length"), F.lit(1).cast("bigint").alias("modified"))
    path = scratch_folder(spark)
    absent = raw.where(~F.col("value").contains("\nTo: ")).select("path")
    ledger.parse_files(raw, listed.join(absent, "path", "left_anti"), 0).write.parquet(path)
    grown = raw.withColumn("value", F.when(F.col("value").contains("\nX-cc: "), F.concat("value", F.lit("more\n"))).otherwise(F.col("value")))
    now = grown.select("path", F.octet_length("value").cast("bigint").alias("length"), F.lit(1).cast("bigint").alias("modified"))
    new = ledger.unseen(now, ledger.ledger_of(spark.read.parquet(path)))
    ledger.parse_files(grown, new, 1).write.mode("append").parquet(path)
    parsed = spark.read.parquet(path)
    times = parsed.groupBy("path").agg(F.count(F.lit(1)).alias("opened"), F.max("load").alias("load"))
    return ledger.ledger_of(parsed).join(times, "path").select("path", "reason", "length", "opened", "load")


# --- versions -------------------------------------------------------------------


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "conversations")


def _text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.column_versions(_turns(spark, sf_dir), CONVERSATION_KEYS, "turn", "text")


def all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.all_versions(_turns(spark, sf_dir), CONVERSATION_KEYS, "turn", ["role", "text"])


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.latest_versions(_text_cells(spark, sf_dir), CONVERSATION_KEYS)


def newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest values per user, under the bound of the users table."""
    cells = versions.column_versions(inputs.table(spark, sf_dir, "events"), ["user_id"], "event_id", "value")
    return versions.newest_versions(cells, ["user_id"], schemas.USERS_MAX_VERSIONS)


def compacted_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bound kept in storage: cells older than their user's threshold are dropped."""
    cells = versions.column_versions(inputs.table(spark, sf_dir, "events"), ["user_id"], "event_id", "value")
    path = scratch_folder(spark)
    versions.version_thresholds(cells, ["user_id"], schemas.USERS_MAX_VERSIONS).write.parquet(path)
    return versions.compact_versions(cells, spark.read.parquet(path), ["user_id"])


def values_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event the user's newest purchase up to then (-1 if none), and its value."""
    events = inputs.table(spark, sf_dir, "events")
    bought = versions.column_versions(events.where("event_type = 'purchase'"), ["user_id"], "event_id", "value")
    asks = events.select("user_id", F.col("event_id").alias("at"))
    found = asof.values_as_of(bought, asks, ["user_id"], slice_rows=AS_OF_SLICE)
    return found.withColumn("ts", F.coalesce("ts", F.lit(-1)))


def version_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of the three newest turns, shown as rows with their position."""
    arrays = versions.version_arrays(_text_cells(spark, sf_dir), CONVERSATION_KEYS, 3)
    return arrays.select("conv_id", F.posexplode("cells").alias("pos", "cell")).select(
        "conv_id", "pos", F.col("cell.ts").alias("ts"), F.col("cell.value").alias("value")
    )


def version_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of the four newest cells of two columns, shown cell by cell with their sizes."""
    cells = versions.all_versions(_turns(spark, sf_dir), CONVERSATION_KEYS, "turn", ["role", "text"])
    table = versions.version_table(cells, CONVERSATION_KEYS, ["role", "text"], 4)
    sized = table.select("conv_id", F.size("role").alias("n_roles"), F.size("text").alias("n_texts"), "role", "text")
    both = sized.select(
        "conv_id", "n_roles", "n_texts", F.posexplode(F.arrays_zip("role", "text")).alias("pos", "cell")
    )
    return both.select(
        "conv_id",
        "n_roles",
        "n_texts",
        "pos",
        F.col("cell.role.ts").alias("role_ts"),
        F.col("cell.role.value").alias("role"),
        F.col("cell.text.ts").alias("text_ts"),
        F.col("cell.text.value").alias("text"),
    )


def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_counts(_text_cells(spark, sf_dir), CONVERSATION_KEYS)


def version_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_timestamps(_text_cells(spark, sf_dir), CONVERSATION_KEYS)


def value_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.value_at(_text_cells(spark, sf_dir), 1)


def selected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest versions of each of two columns."""
    cells = versions.all_versions(_turns(spark, sf_dir), CONVERSATION_KEYS, "turn", ["role", "text"])
    return versions.select_cells(cells, CONVERSATION_KEYS, ["role", "text"], 2)


def copied_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = versions.all_versions(
        _turns(spark, sf_dir).withColumn("text", F.col("text").cast("binary")),
        CONVERSATION_KEYS,
        "turn",
        ["text"],
    )
    copies = versions.copy_column(cells, "text", "text_copy")
    return copies.select("conv_id", "ts", "column", F.col("value").cast("string").alias("value"))


# --- counting, loading, filtering --------------------------------------------


def _event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.column_versions(
        inputs.table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type"
    )


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.value_counts(_event_types(spark, sf_dir))


def value_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (record, 1) pairs after the grouped pass-through."""
    pairs = counting.value_pairs(_event_types(spark, sf_dir))
    return counting.grouped_by_key(pairs, "key").select(F.col("key.id").alias("id"), "one")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``type:user`` lines; those of errors have a third part, those of sign-ups no number."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    line = (
        F.when(kind == "error", F.concat_ws(":", kind, user, F.lit("x")))
        .when(kind == "signup", F.concat_ws(":", kind, F.concat(F.lit("u"), user)))
        .when(kind == "view", F.concat_ws(":", kind, F.concat(F.lit("-"), user)))
        .otherwise(F.concat_ws(":", kind, user))
    )
    return inputs.table(spark, sf_dir, "events").select(line.alias("value"))


def keyed_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.keyed_ints(_lines(spark, sf_dir))


def keyed_int_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.keyed_int_rejects(_lines(spark, sf_dir))


def domain_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.from_domain(inputs.emails(spark, sf_dir), inputs.DOMAIN).select("from", "ts", "mid")


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of cut on page addresses: pages per host."""
    host = F.regexp_replace(F.regexp_replace("url", ".*//", ""), "/.*", "")
    pages = inputs.table(spark, sf_dir, "pages").select(host.alias("value"))
    return counting.value_counts(pages)


def document_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the first sentence of each cleaned document, in their order."""
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", text.clean_body(F.col("text")).alias("body"))
    return docs.select("doc_id", F.posexplode(text.first_sentence_words(F.col("body"))).alias("pos", "word"))


def chosen_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a stored table under new names."""
    return tables.read_cells(spark, f"{sf_dir}/pages.parquet", {"page_id": "id", "url": "address"})


def top_senders_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question as a statement over the view of all versions."""
    views.register_employee(inputs.employee(spark, sf_dir), "postmill_employee")
    return spark.sql(
        """
        select fromStr.value as `from`, count(mid) as count from postmill_employee
        group by fromStr.value order by count desc, `from` limit 10
        """
    )


def top_correspondents_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_employee(inputs.employee(spark, sf_dir), "postmill_employee")
    return spark.sql(
        """
        with addressed as (
          select fromStr.value as sender, explode(split(toStr.value, ',')) as address from postmill_employee)
        select sender as `from`, trim(address) as `to`, count(*) as count
        from addressed group by all order by count desc, `from`, `to` limit 10
        """
    )


def weekly_sentiment_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_emails(inputs.scored(spark, sf_dir), "postmill_emails")
    return spark.sql(
        f"""
        with dated as (
          select dateLong.ts as sent, double(sentiment.value) as score
          from postmill_emails where split_part(fromStr.value, '@', -1) = '{inputs.DOMAIN}')
        select 52 * (extract(year from sent) - 1999) + extract(week from sent) as weeknum,
          round(mean(score), 6) as avgsentiment, round(sqrt(var_pop(score)), 6) as stddevsentiment,
          count(*) as nummessages
        from dated group by all
        """
    )


def words_by_sentiment_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_emails(inputs.scored(spark, sf_dir), "postmill_emails")
    return spark.sql(
        f"""
        with domain_mail as (
          select transform(get(sentences(body.value), 0), w -> lower(w)) as terms, sentiment.value as score
          from postmill_emails where split_part(fromStr.value, '@', -1) = '{inputs.DOMAIN}'),
        occurrences as (select explode(terms) as word, score from domain_mail)
        select word, round(sum(score), 6) as totalsentiment
        from occurrences group by word order by totalsentiment, word
        """
    )


VERSION_BOUND = 12


def newest_by_sender_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and newest cells of the view with arrays, and whether the bound cut them."""
    views.register_employee_arrays(inputs.employee(spark, sf_dir), VERSION_BOUND, "postmill_arrays")
    return spark.sql(
        """
        select fromStr.value as `from`, size(mid) as versions, mid[0].value as newest,
          unix_millis(mid[size(mid) - 1].ts) as oldest_ts, truncated
        from postmill_arrays
        """
    )


def newest_correspondents_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients in the kept versions: two lateral views, one upon the other."""
    views.register_employee_arrays(inputs.employee(spark, sf_dir), VERSION_BOUND, "postmill_arrays")
    return spark.sql(
        """
        select fromStr.value as `from`, trim(address) as `to`, count(*) as count
        from postmill_arrays
          lateral view explode(toStr) as kept
          lateral view explode(split(kept.value, ',')) as address
        group by all
        """
    )


def email_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell view, read back through struct fields."""
    cells = views.cell_view(inputs.scored(spark, sf_dir), views.EMAIL_CELLS)
    return cells.select(
        F.col("fromStr.value").alias("from"),
        F.unix_millis("dateLong.ts").alias("ts"),
        dates.week_index(dates.utc_date(F.unix_millis("dateLong.ts"))).alias("weeknum"),
        F.col("toStr.value").alias("to"),
        F.col("sentiment.value").alias("sentiment"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in [
        top_senders,
        top_senders_by_versions,
        top_correspondents,
        top_correspondents_by_sketch,
        top_correspondents_by_versions,
        correspondent_counts,
        correspondent_version_counts,
        weekly_sentiment,
        weekly_event_values,
        weekly_event_values_merged,
        words_by_sentiment,
        words_by_sentiment_from_index,
        message_sentiment,
        message_sentiment_by_join,
        message_sentiment_by_filter,
        sentiment_cells,
        message_keywords,
        message_keywords_of_counts,
        term_counts,
        term_counts_stop_table,
        raw_term_counts,
        row_normalised_texts,
        document_frequency,
        document_frequency_of_counts,
        document_frequency_by_deltas,
        inverse_document_frequency,
        word_scores,
        row_normalised_values,
        imported_emails,
        imported_emails_intended,
        imported_employee,
        import_rejects,
        import_tally,
        import_ledger,
        clean_bodies,
        upserted_emails,
        merged_emails,
        upserted_buckets,
        all_versions,
        latest_versions,
        newest_versions,
        compacted_versions,
        version_arrays,
        version_table,
        version_counts,
        version_timestamps,
        value_at_version,
        values_as_of,
        selected_cells,
        copied_column,
        value_counts,
        value_pairs,
        keyed_ints,
        keyed_int_rejects,
        domain_messages,
        page_hosts,
        document_sentences,
        chosen_cells,
        top_senders_sql,
        top_correspondents_sql,
        weekly_sentiment_sql,
        words_by_sentiment_sql,
        newest_by_sender_sql,
        newest_correspondents_sql,
        email_cells,
    ]
}
