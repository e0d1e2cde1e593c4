"""The registered queries: each reads the tables of a testdata folder."""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.history import read_history
from .operators.skew import Hot, hot_keys
from .operators.storage import ROW_GROUP_BYTES, new_folder, spread, stored, stored_all
from .plans import build, extraction, intermediate, marts, staging
from .plans.history import contract_history, merge_contract_history
from .plans.validation import validate
from .sources import contracts as contract_files
from .sources import objects, seeds, testdata
from .sources import tables as layered
from .streaming import events, ingest, landing

AS_OF = date(1999, 1, 1)
EXTRACTED_AT = datetime(2024, 1, 15, 10, 30)
FIRST_LOAD = datetime(2024, 1, 1)
SECOND_LOAD = datetime(2024, 2, 1)
THIRD_LOAD = datetime(2024, 3, 1)
BUCKET = "raw"
FILES_PER_BATCH = 1000
BUCKETS = 32


def _plain(df: DataFrame, *drop: str) -> DataFrame:
    """Without audit timestamps, which differ from run to run."""
    return df.select([c for c in df.columns if not c.startswith("_") and c not in drop])


# --- staging ---------------------------------------------------------------


def raw_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return testdata.raw_contracts(spark, folder).drop("extraction_metadata", "loaded_at")


def stg_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(staging.stg_contracts(testdata.raw_contracts(spark, folder)))


def _stored_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return stored(staging.stg_contracts(testdata.raw_contracts(spark, folder)), "stg_contracts")


def _rates(spark: SparkSession, folder: str, contracts: DataFrame, hot: Hot) -> DataFrame:
    return staging.stg_rate_schedules(testdata.rate_lines(spark, folder, contracts, hot), hot)


def _amendments(spark: SparkSession, folder: str, contracts: DataFrame) -> DataFrame:
    hot = testdata.hot_amendment_contracts(spark, folder)
    return staging.stg_amendments(testdata.amendment_lines(spark, folder, contracts, hot), hot)


def stg_rate_schedules(spark: SparkSession, folder: str) -> DataFrame:
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    return _plain(_rates(spark, folder, contracts, testdata.hot_rate_contracts(spark, folder)))


def stg_amendments(spark: SparkSession, folder: str) -> DataFrame:
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    return _plain(_amendments(spark, folder, contracts))


def _staged(spark: SparkSession, folder: str, amendments: bool = False) -> build.Staged:
    contracts = _stored_contracts(spark, folder)
    hot = testdata.hot_rate_contracts(spark, folder)
    lines = {"stg_rate_schedules": _rates(spark, folder, contracts, hot)}
    if amendments:
        lines["stg_amendments"] = _amendments(spark, folder, contracts)
    lines = stored_all(lines, ROW_GROUP_BYTES)
    return build.Staged(
        contracts,
        lines["stg_rate_schedules"],
        lines.get("stg_amendments"),
        build.repeated_contracts(contracts),
        hot,
    )


# --- intermediate ----------------------------------------------------------


def rate_stats(spark: SparkSession, folder: str) -> DataFrame:
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    hot = testdata.hot_rate_contracts(spark, folder)
    return intermediate.rate_stats(_rates(spark, folder, contracts, hot))


def amendment_stats(spark: SparkSession, folder: str) -> DataFrame:
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    return intermediate.amendment_stats(_amendments(spark, folder, contracts))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    contracts = _stored_contracts(spark, folder)
    hot = testdata.hot_rate_contracts(spark, folder)
    return intermediate.int_contracts_enriched(
        contracts,
        _rates(spark, folder, contracts, hot),
        _amendments(spark, folder, contracts),
        AS_OF,
    )


def int_contracts_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_enriched(spark, folder))


def int_rates_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """The general form: the contract status comes from a join."""
    contracts = _stored_contracts(spark, folder)
    hot = testdata.hot_rate_contracts(spark, folder)
    rates = _rates(spark, folder, contracts, hot)
    enriched = intermediate.int_contracts_enriched(
        contracts, rates, _amendments(spark, folder, contracts), AS_OF
    )
    return _plain(intermediate.int_rates_normalized(rates, enriched, None, AS_OF, hot))


def _ref_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Category reference from the part types but one."""
    return (
        testdata.table(spark, folder, "part")
        .where("p_type <> 'ECONOMY'")
        .select(
            F.lower("p_type").alias("category_code"),
            F.concat(F.lit("Type "), F.lower("p_type")).alias("category_name"),
            F.concat(F.lit("All parts of type "), F.col("p_type")).alias("description"),
        )
        .distinct()
    )


def _ref_payers(spark: SparkSession, folder: str) -> DataFrame:
    """Payer reference from the nations with an even key."""
    return (
        testdata.table(spark, folder, "nation")
        .where("n_nationkey % 2 = 0")
        .selectExpr(
            "concat('P-', lpad(string(n_nationkey), 3, '0')) AS payer_id",
            "n_name AS payer_name",
            """CASE n_regionkey WHEN 0 THEN 'COMMERCIAL' WHEN 1 THEN 'HMO'
                                WHEN 2 THEN 'UNLISTED' ELSE 'PPO' END AS payer_type""",
            "concat('R', n_regionkey) AS payer_state",
            "concat('https://example.com/', n_nationkey) AS payer_website",
        )
    )


def int_rates_normalized_ref(spark: SparkSession, folder: str) -> DataFrame:
    contracts = _stored_contracts(spark, folder)
    hot = testdata.hot_rate_contracts(spark, folder)
    staged = build.Staged(
        contracts,
        _rates(spark, folder, contracts, hot),
        None,
        build.repeated_contracts(contracts),
        hot,
    )
    enriched = None
    if staged.repeated is not None:
        enriched = intermediate.int_contracts_enriched(
            contracts, staged.rates, _amendments(spark, folder, contracts), AS_OF
        )
    return _plain(
        build.normalized_rates(staged, enriched, _ref_categories(spark, folder), AS_OF)
    )


# --- marts -----------------------------------------------------------------


def dim_contract(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(marts.dim_contract(_enriched(spark, folder)))


def dim_payer(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(marts.dim_payer(_stored_contracts(spark, folder), as_of=AS_OF))


def dim_payer_ref(spark: SparkSession, folder: str) -> DataFrame:
    contracts = _stored_contracts(spark, folder)
    return _plain(marts.dim_payer(contracts, _ref_payers(spark, folder), AS_OF))


def dim_payer_deduped(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(marts.dim_payer(_stored_contracts(spark, folder), as_of=AS_OF, dedupe=True))


def dim_provider(spark: SparkSession, folder: str) -> DataFrame:
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    return _plain(marts.dim_provider(contracts, AS_OF))


def _service_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Only what the service dimension reads; without a line number there is no window."""
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    rates = _rates(spark, folder, contracts, testdata.hot_rate_contracts(spark, folder))
    needed = rates.select(
        "contract_id", "provider_npi", "service_category", "cpt_code", "rate_amount"
    )
    return stored(needed, "service_rates")


def dim_service(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(marts.dim_service(_service_rates(spark, folder)))


def dim_service_ref(spark: SparkSession, folder: str) -> DataFrame:
    rates = _service_rates(spark, folder)
    return _plain(marts.dim_service(rates, _ref_categories(spark, folder)))


def dim_service_deduped(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(marts.dim_service(_service_rates(spark, folder), dedupe=True))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The days that the contracts cover."""
    contracts = staging.stg_contracts(testdata.raw_contracts(spark, folder))
    days = marts.days_between(contracts, "effective_date", "termination_date")
    return marts.calendar(days, AS_OF)


def _fact(
    spark: SparkSession, folder: str, staged: build.Staged, buckets: int = 0
) -> DataFrame:
    enriched = None
    dimensions = {
        "dim_payer": marts.dim_payer(staged.contracts).select("payer_key", "payer_id"),
        "dim_provider": marts.dim_provider(staged.contracts).select("provider_key", "provider_npi"),
        "dim_service": marts.dim_service(staged.rates).select("service_key", "cpt_code"),
        "dim_date": marts.dim_date(spark, *build.covered_days(staged)).select(
            "date_key", "full_date"
        ),
    }
    if staged.repeated is not None:
        enriched = stored(
            intermediate.int_contracts_enriched(
                staged.contracts, staged.rates, _amendments(spark, folder, staged.contracts), AS_OF
            ),
            "int_contracts_enriched",
        )
        dimensions["dim_contract"] = marts.dim_contract(enriched)
    dimensions = stored_all(dimensions)
    rates = build.normalized_rates(staged, enriched, None, AS_OF)
    return _plain(build.fact_table(staged, rates, dimensions, buckets))


def fact_contracted_rates(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder, _staged(spark, folder))


def _fact_of_documents(documents: DataFrame, latest_load: bool = False) -> DataFrame:
    raw = contract_files.with_load_time(documents)
    staged = build.stage(raw, latest_load=latest_load)
    return _plain(build.build(staged, AS_OF)["fact_contracted_rates"])


def fact_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From nested records with unique contract ids."""
    return _fact_of_documents(testdata.contract_documents(spark, folder))


def fact_of_reloaded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Some documents are loaded twice: their rates multiply."""
    return _fact_of_documents(testdata.reloaded_documents(spark, folder))


def fact_of_latest_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Of documents loaded twice, the latest load counts."""
    return _fact_of_documents(testdata.reloaded_documents(spark, folder), latest_load=True)


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = build.build(_staged(spark, folder, amendments=True), AS_OF)
    return build.quality_report(
        tables, _ref_payers(spark, folder), _ref_categories(spark, folder)
    )


# --- published tables ------------------------------------------------------


def _publish_to(spark: SparkSession, name: str) -> None:
    """Keep the database of the table's layer in the shared folder, unless there is one already."""
    where = new_folder(spark, layered.layer(name))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layered.layer(name)} LOCATION '{where}'")


def published_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a bucketed table of its layer, read back."""
    fact = _fact(spark, folder, _staged(spark, folder), BUCKETS)
    _publish_to(spark, "fact_contracted_rates")
    layered.save_fact(fact, buckets=BUCKETS, deal=False)
    return layered.load_table(spark, "fact_contracted_rates")


def published_contract_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and value of each contract: two bucketed tables meet and are grouped where they lie."""
    staged = _staged(spark, folder)
    _publish_to(spark, "fact_contracted_rates")
    layered.save_fact(_fact(spark, folder, staged, BUCKETS), buckets=BUCKETS, deal=False)
    enriched = intermediate.int_contracts_enriched(
        staged.contracts, staged.rates, _amendments(spark, folder, staged.contracts), AS_OF
    )
    _publish_to(spark, "dim_contract")
    contracts = _plain(marts.dim_contract(enriched))
    layered.save_bucketed(contracts, "dim_contract", BUCKETS, "contract_key", "contract_id")
    facts = layered.load_table(spark, "fact_contracted_rates")
    contracts = layered.load_table(spark, "dim_contract").where("is_current")
    return (
        contracts.select("contract_key", "contract_id", "contract_duration_days")
        .hint("merge")
        .join(facts.select("contract_key", "rate_amount", "cpt_code"), "contract_key", "left")
        .groupBy("contract_key", "contract_id", "contract_duration_days")
        .agg(
            F.count("rate_amount").alias("lines"),
            F.sum("rate_amount").cast("decimal(22,2)").alias("value"),
            F.max("cpt_code").alias("last_code"),
        )
        .drop("contract_key")
    )


def published_payers(spark: SparkSession, folder: str) -> DataFrame:
    """Payers with a reference from a seed file, as a table of their layer, read through a view."""
    path = new_folder(spark, "seeds") + "/ref_payers.csv"
    _ref_payers(spark, folder).write.option("header", True).csv(path)
    reference = seeds.read_seed(spark, path, "ref_payers")
    payers = _plain(marts.dim_payer(_stored_contracts(spark, folder), reference, AS_OF))
    _publish_to(spark, "dim_payer")
    layered.save_table(payers, "dim_payer")
    layered.save_view(layered.load_table(spark, "dim_payer"), "published_payers")
    return spark.table("published_payers")


# --- history ---------------------------------------------------------------


def _two_loads(contracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Second load: some payers renamed, some contracts expired, new or missing; each is in one."""
    number = F.regexp_extract("contract_id", r"\d+", 0).cast("bigint")
    current = contracts.select(
        "*",
        F.lit("ACTIVE").alias("contract_status"),
        F.datediff("termination_date", "effective_date").cast("bigint").alias(
            "contract_duration_days"
        ),
        number.alias("number"),
    )
    first = current.where("number % 13 <> 0 OR number % 7 = 0")
    second = current.where("number % 7 <> 0").withColumns(
        {
            "payer_name": F.when(F.col("number") % 10 == 0, F.concat("payer_name", F.lit(" NEW")))
            .otherwise(F.col("payer_name")),
            "contract_status": F.when(F.col("number") % 15 == 0, "EXPIRED").otherwise("ACTIVE"),
        }
    )
    return first, second


def contract_history_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    contracts = _stored_contracts(spark, folder)
    first, second = _two_loads(contracts)
    hot = hot_keys(contracts, "contract_id")
    history = stored(contract_history(None, first, FIRST_LOAD), "contract_history")
    return contract_history(history, second, SECOND_LOAD, hot)


def contract_history_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads, and the second once more, merged into a stored history."""
    contracts = _stored_contracts(spark, folder)
    first, second = _two_loads(contracts)
    path, hot = new_folder(spark, "history"), hot_keys(contracts, "contract_id")
    merge_contract_history(path, first, FIRST_LOAD, hot, 16)
    for at in (SECOND_LOAD, SECOND_LOAD, THIRD_LOAD):
        merge_contract_history(path, second, at, hot)
    return read_history(spark, path)


def contract_history_repeated_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every fourth contract is there with two payers, and the third load repeats the second."""
    contracts = _stored_contracts(spark, folder)
    hot = hot_keys(contracts, "contract_id")

    def with_copies(load: DataFrame, every: int) -> DataFrame:
        other = F.when(F.col("number") % every == 0, " B").otherwise(" C")
        copies = load.where("number % 4 = 0")
        return load.unionByName(copies.withColumn("payer_name", F.concat("payer_name", other)))

    first, second = _two_loads(contracts)
    second = with_copies(second, 8)
    one = stored(contract_history(None, with_copies(first, 4), FIRST_LOAD), "contract_history")
    two = stored(contract_history(one, second, SECOND_LOAD, hot), "contract_history")
    return contract_history(two, second, THIRD_LOAD, hot)


# --- nested records, JSON, validation --------------------------------------


def rates_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Unnest and number without a shuffle."""
    raw = contract_files.with_load_time(testdata.contract_documents(spark, folder))
    contracts = staging.stg_contracts(raw)
    return _plain(staging.numbered_rates_of_unique_contracts(contracts))


def amendments_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    raw = contract_files.with_load_time(testdata.contract_documents(spark, folder))
    contracts = staging.stg_contracts(raw)
    return _plain(staging.numbered_amendments_of_unique_contracts(contracts))


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write nested records as partitioned JSON, read them back, unnest the rate lines."""
    path = new_folder(spark, "contracts")
    contract_files.write_contracts(testdata.contract_documents(spark, folder), path)
    raw = contract_files.read_contracts(spark, path, multi_line=False)
    contracts = staging.stg_contracts(contract_files.with_load_time(raw))
    return staging.rate_lines(contracts)


def load_new_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Load part of the documents, some twice, then all of them: each source file is there once."""
    path = new_folder(spark, "raw_contracts")
    documents = testdata.contract_documents(spark, folder)
    part = documents.where(F.crc32(F.col("contract_id").cast("binary")) % 3 != 0)
    again = part.where(F.crc32(F.col("contract_id").cast("binary")) % 5 == 0)
    contract_files.append_raw(part.unionByName(again), path)
    contract_files.append_raw(documents, path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("extraction_metadata.source_file").alias("source_file"))
        .agg(F.count(F.lit(1)).alias("copies"), F.sum(F.size("rate_schedules")).alias("lines"))
    )


def validate_contracts(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate(testdata.contract_documents(spark, folder), coerce=True)
    return checked.select(
        "contract_id",
        "is_valid",
        F.array_join("errors", "; ").alias("errors"),
        F.array_join("rate_schedules.rate_type", ",").alias("rate_types"),
        F.array_join("amendments.amendment_type", ",").alias("amendment_types"),
    )


# --- extraction ------------------------------------------------------------


def _extracted(documents: DataFrame, tables_available: bool = True) -> DataFrame:
    at = F.lit(EXTRACTED_AT).cast("timestamp")
    return extraction.extract_contracts(documents, at, tables_available)


def _fields(records: DataFrame) -> DataFrame:
    return records.select(
        "contract_id",
        "payer_name",
        "payer_id",
        "provider_npi",
        "provider_name",
        "effective_date",
        "termination_date",
        F.size("rate_schedules").cast("bigint").alias("rate_lines"),
        F.size("amendments").cast("bigint").alias("amendments"),
        F.col("extraction_metadata.source_file").alias("source_file"),
        F.col("extraction_metadata.confidence_score").alias("confidence_score"),
    )


def extract_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(_extracted(testdata.contract_texts(spark, folder)))


def extract_fields_without_tables(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(_extracted(testdata.contract_texts(spark, folder), tables_available=False))


def extract_rate_rows(spark: SparkSession, folder: str) -> DataFrame:
    records = _extracted(testdata.contract_texts(spark, folder))
    return records.select(
        F.col("extraction_metadata.source_file").alias("source_file"), F.inline("rate_schedules")
    ).select("source_file", "service_category", "cpt_code", "rate_type", "rate_amount")


def extract_amendments(spark: SparkSession, folder: str) -> DataFrame:
    records = _extracted(testdata.contract_texts(spark, folder))
    return records.select(
        F.col("extraction_metadata.source_file").alias("source_file"), F.inline("amendments")
    ).select(
        "source_file", "amendment_id", "amendment_date", "description", "amendment_type"
    )


def extract_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Prose of any length, mostly without contract terms."""
    documents = spread(testdata.table(spark, folder, "documents")).selectExpr(
        "concat('documents/', doc_id) AS source_file",
        "text",
        "cast(NULL AS array<struct<headers:array<string>,rows:array<array<string>>>>) AS tables",
    )
    return _fields(_extracted(documents))


def split_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rate rows of tables that come as grids of cells."""
    grid = F.transform("tables", lambda t: F.concat(F.array(t["headers"]), t["rows"]))
    texts = testdata.contract_texts(spark, folder).withColumn("grids", grid)
    tables = F.transform("grids", extraction.split_table)
    rates = texts.select("source_file", F.inline(extraction.rate_schedules(tables)))
    return rates.select("source_file", "service_category", "cpt_code", "rate_type", "rate_amount")


# --- objects -----------------------------------------------------------------


def contracts_of_payers(spark: SparkSession, folder: str) -> DataFrame:
    """Only the folders of two payers are read."""
    path = new_folder(spark, "contracts")
    contract_files.write_contracts(testdata.contract_documents(spark, folder), path)
    read = contract_files.read_contracts(spark, path, multi_line=False, folders=True)
    return read.where("payer IN ('pay3', 'unknown') AND contract_date < '1998-01-01'").select(
        "contract_id", "payer", "contract_date"
    )


def pdf_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files read as a table, and by a stream whose files one listing finds."""
    path, out, checkpoint = (new_folder(spark, n) for n in ("objects", "sizes", "checkpoint"))
    objects.write_objects(testdata.page_objects(spark, folder), path)

    def write(files: DataFrame, batch_id: int) -> None:
        files.select("path", "length").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = ingest.pdf_stream(spark, path, landing.OBJECTS_PER_BATCH)
    ingest.start(stream, write, checkpoint, True).awaitTermination()
    name = F.element_at(F.split("path", "/"), -1)
    streamed = spark.read.parquet(out).select("path", F.col("length").alias("streamed_bytes"))
    listed = contract_files.list_objects(spark, path).select("path", F.lit(True).alias("listed"))
    return (
        contract_files.pdf_files(spark, path)
        .select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        .join(streamed, "path", "left")
        .join(listed, "path", "left")
        .select(name.alias("name"), "bytes", "sha256", "streamed_bytes", "listed")
    )


# --- messages and streams --------------------------------------------------


def route_messages(spark: SparkSession, folder: str) -> DataFrame:
    routed = events.route_messages(testdata.messages(spark, folder), BUCKET)
    return routed.select("bucket", "object_key", "outcome")


def stream_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through a stream; what was accepted and what was rejected."""
    source, out, rejects, checkpoint = (
        new_folder(spark, name) for name in ("messages", "accepted", "rejected", "checkpoint")
    )
    testdata.messages(spark, folder).write.text(source)
    writer = ingest.message_writer(BUCKET, out, rejects)
    stream = ingest.message_stream(spark, source, FILES_PER_BATCH)
    ingest.start(stream, writer, checkpoint, True).awaitTermination()
    accepted = spark.read.parquet(out).select("object_key", F.lit("accepted").alias("outcome"))
    rejected = spark.read.parquet(rejects).select(
        F.lit(None).cast("string").alias("object_key"), "outcome"
    )
    return accepted.unionByName(rejected).groupBy("object_key", "outcome").agg(
        F.count(F.lit(1)).alias("messages")
    )


def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents through a stream: the records equal those of the batch plan."""
    source, out, rejects, checkpoint = (
        new_folder(spark, name) for name in ("documents", "records", "rejects", "checkpoint")
    )
    testdata.contract_texts(spark, folder).write.json(source)
    writer = ingest.document_writer(out, rejects, F.lit(EXTRACTED_AT).cast("timestamp"))
    stream = ingest.document_stream(spark, source, FILES_PER_BATCH)
    ingest.start(stream, writer, checkpoint, True).awaitTermination()
    return _fields(spark.read.parquet(out))


def _landed(spark: SparkSession, folder: str) -> landing.Zone:
    """All messages and most documents; then the late documents, and every fifth message again.

    A third round finds what is still missing, a fourth nothing new. Done once per session.
    """
    known = (spark.sparkContext.applicationId, folder)
    if known in _zones:
        return _zones[known]
    zone = landing.Zone.below(new_folder(spark, "landing"))
    store = new_folder(spark, "documents")
    documents = stored(testdata.document_store(spark, folder), "document_texts")
    messages = stored(testdata.document_messages(spark, folder), "document_messages")
    at = F.lit(EXTRACTED_AT).cast("timestamp")
    # made once, before there are objects: each time lists them all
    new_objects = landing.contract_stream(
        spark, zone.contracts, landing.OBJECTS_PER_BATCH, folders=False
    )
    rounds = (
        ("NOT late", "true"),
        ("late", "number % 5 = 0"),
        (None, None),
        (None, "number % 7 = 0"),
    )
    for arrived, sent in rounds:
        if arrived:
            ingest.write_documents(documents.where(arrived).drop("late"), store, 16)
        if sent:
            messages.where(sent).select("body").write.mode("append").text(zone.inbox)
        landing.land(
            spark, zone, spark.read.parquet(store), BUCKET, at, FILES_PER_BATCH, new_objects=new_objects
        )
    _zones[known] = zone
    return zone


_zones: dict[tuple[str, str], landing.Zone] = {}


def rejected_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without text, and lines that cannot be read, with the kind of file they came from."""
    source, out, rejects, checkpoint = (
        new_folder(spark, name) for name in ("documents", "records", "rejects", "checkpoint")
    )
    documents = testdata.document_store(spark, folder)
    line = F.to_json(F.struct("source_file", "text", "tables"))
    broken = F.when(F.col("late"), F.left(line, F.lit(25))).otherwise(line)
    documents.select(broken.alias("value")).write.text(source)
    writer = ingest.document_writer(out, rejects, F.lit(EXTRACTED_AT).cast("timestamp"))
    stream = ingest.document_stream(spark, source, FILES_PER_BATCH)
    ingest.start(stream, writer, checkpoint, True).awaitTermination()
    return spark.read.parquet(rejects).select(
        "source_file",
        F.col(contract_files.CORRUPT).alias("line"),
        F.element_at(F.split(ingest.INPUT_FILE, "\\."), -1).alias("kind"),
    )


def documents_to_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Messages to documents, records, JSON objects, the raw table and the fact."""
    raw = contract_files.read_raw(spark, _landed(spark, folder).raw)
    return _plain(build.build(build.stage(raw), AS_OF)["fact_contracted_rates"])


def landed_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Folders and names of the JSON objects, listed without reading them."""
    found = contract_files.list_objects(spark, _landed(spark, folder).contracts, ".json")
    parts = F.split("path", "/")
    return found.select(
        *[F.element_at(parts, -3 + i).alias(c) for i, c in enumerate(("payer", "day", "name"))]
    )


def rejected_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """What was set aside after three attempts, and how many messages each took."""
    rejects = spark.read.parquet(_landed(spark, folder).rejects)
    return rejects.select(
        F.coalesce("object_key", "body").alias("message"),
        "problem",
        F.col("attempts").cast("bigint").alias("attempts"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        raw_contracts,
        stg_contracts,
        stg_rate_schedules,
        stg_amendments,
        rate_stats,
        amendment_stats,
        int_contracts_enriched,
        int_rates_normalized,
        int_rates_normalized_ref,
        dim_contract,
        dim_payer,
        dim_payer_ref,
        dim_payer_deduped,
        dim_provider,
        dim_service,
        dim_service_ref,
        dim_service_deduped,
        dim_date,
        fact_contracted_rates,
        fact_of_documents,
        fact_of_reloaded_documents,
        fact_of_latest_documents,
        dq_report,
        published_fact,
        published_contract_totals,
        published_payers,
        contract_history_two_loads,
        contract_history_merged,
        contract_history_repeated_ids,
        rates_of_documents,
        amendments_of_documents,
        json_roundtrip,
        load_new_contracts,
        validate_contracts,
        extract_fields,
        extract_fields_without_tables,
        extract_rate_rows,
        extract_amendments,
        extract_documents,
        route_messages,
        stream_messages,
        stream_documents,
        split_tables,
        contracts_of_payers,
        pdf_bytes,
        rejected_documents,
        documents_to_fact,
        landed_objects,
        rejected_deliveries,
    )
}
