"""Contracts derived from the order tables under testdata.

An order is a contract, its line items are rate lines, events are amendments.
Remainders of the keys decide which rows are missing, malformed or ambiguous,
so that every branch of the models is reached. Lines stay flat: an order with
very many line items never becomes one giant array.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, Hot, HotKeys, hot_keys, salted_join
from ..operators.storage import spread
from ..plans.staging import amendment_fields, rate_fields
from ..schemas import RATE_SCHEDULE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CONTRACT_ID = "CASE WHEN {k} % 97 = 0 THEN NULL ELSE concat('CON-', {k}) END"


def raw_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw contract headers, all dates as text."""
    supplier_of_order = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("s_suppkey"))
    )
    joined = (
        spread(table(spark, folder, "orders"))
        .join(
            table(spark, folder, "customer").select(
                F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
            ),
            "o_custkey",
        )
        .join(table(spark, folder, "nation"), "n_nationkey")
        .join(supplier_of_order, "o_orderkey", "left")
        .join(table(spark, folder, "supplier").select("s_suppkey", "s_name"), "s_suppkey", "left")
    )
    return joined.selectExpr(
        CONTRACT_ID.format(k="o_orderkey") + " AS contract_id",
        """concat(' ', n_name, CASE WHEN n_nationkey IN (3, 7) AND o_orderkey % 2 = 0
                  THEN ' LTD' ELSE '' END) AS payer_name""",
        """CASE WHEN o_orderkey % 53 = 0 THEN NULL
                ELSE concat('p-', lpad(string(n_nationkey), 3, '0'), ' ') END AS payer_id""",
        """CASE WHEN o_orderkey % 59 = 0 THEN NULL
                ELSE lpad(string(s_suppkey), 10, '0') END AS provider_npi""",
        "replace(s_name, '#', char(9)) AS provider_name",
        """CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'null'
                WHEN o_orderkey % 23 = 0 THEN NULL
                ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS effective_date""",
        """CASE WHEN o_orderkey % 11 = 0 THEN NULL
                WHEN o_orderkey % 31 = 0
                THEN date_format(date_sub(date(o_orderdate), 30), 'yyyy-MM-dd')
                ELSE date_format(date_add(date(o_orderdate), int(365 * (1 + o_orderkey % 4))),
                                 'yyyy-MM-dd') END AS termination_date""",
        """named_struct(
             'extracted_at', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
             'confidence_score', cast((o_orderkey % 101) / 100 AS decimal(5,4)),
             'source_file', concat('incoming/', o_orderkey, '.pdf'),
             'extractor_version', '1.0.0') AS extraction_metadata""",
        "timestamp(o_orderdate) AS loaded_at",
    )


def _with_context(lines: DataFrame, contracts: DataFrame, hot: Hot) -> DataFrame:
    headers = contracts.select(
        "contract_id",
        "payer_id",
        "provider_npi",
        F.col("effective_date").alias("contract_effective_date"),
        F.col("termination_date").alias("contract_termination_date"),
    )
    return salted_join(lines, headers, "contract_id", "inner", hot)


def _hot_contracts(df: DataFrame, key: str, min_rows: int) -> HotKeys:
    return hot_keys(df.select(F.concat(F.lit("CON-"), key).alias("id")), "id", min_rows=min_rows)


def hot_rate_contracts(spark: SparkSession, folder: str, min_rows: int = HOT_ROWS) -> HotKeys:
    return _hot_contracts(table(spark, folder, "lineitem"), "l_orderkey", min_rows)


def hot_amendment_contracts(
    spark: SparkSession, folder: str, min_rows: int = HOT_ROWS
) -> HotKeys:
    events = table(spark, folder, "events").selectExpr("event_id DIV 3 AS ok")
    return _hot_contracts(events, "ok", min_rows)


def rate_lines(
    spark: SparkSession, folder: str, contracts: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Line items as raw rate lines of the staged `contracts`."""
    lines = (
        spread(table(spark, folder, "lineitem"))
        .where("l_orderkey % 41 <> 0 AND l_orderkey % 97 <> 0")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            CONTRACT_ID.format(k="l_orderkey") + " AS contract_id",
            """concat(lower(p_type), CASE WHEN p_partkey % 50 = 0 AND l_linenumber % 2 = 0
                      THEN '_ALT ' ELSE ' ' END) AS service_category""",
            "concat('P', lpad(string(p_partkey), 6, '0')) AS cpt_code",
            "p_name AS description",
            """CASE l_returnflag WHEN 'A' THEN 'per_diem' WHEN 'N' THEN 'PERCENTAGE'
                    ELSE 'Fee_Schedule' END AS rate_type""",
            """CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN 0
                    WHEN l_partkey % 37 = 0 THEN -l_extendedprice
                    WHEN l_returnflag = 'N' THEN l_discount * 1000
                    ELSE l_extendedprice END AS rate_amount""",
            """CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN 'null'
                    ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS effective_date""",
            "CASE WHEN l_linestatus = 'F' THEN 'day' END AS rate_unit",
            "cast(NULL AS string) AS modifier",
        )
    )
    typed = lines.select("contract_id", *rate_fields(F.col))
    hot = hot_rate_contracts(spark, folder) if hot is None else hot
    return _with_context(typed, contracts, hot)


def amendment_lines(
    spark: SparkSession, folder: str, contracts: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Events as raw amendments of the staged `contracts`, three per contract."""
    lines = table(spark, folder, "events").selectExpr(
        CONTRACT_ID.format(k="(event_id DIV 3)") + " AS contract_id",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('AMD-', event_id) END AS amendment_id",
        """CASE WHEN event_id % 11 = 0 THEN '' ELSE date_format(ts, 'yyyy-MM-dd') END
           AS amendment_date""",
        "concat(' ', event_type) AS description",
        "props AS rate_changes",
    )
    typed = lines.where("contract_id IS NOT NULL").select(
        "contract_id", *amendment_fields(F.col)
    )
    hot = hot_amendment_contracts(spark, folder) if hot is None else hot
    return _with_context(typed, contracts, hot)


def contract_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested contract records, one per order, built from the order row alone.

    Contracts start on the first of a month.
    """
    orders = spread(table(spark, folder, "orders")).withColumn("k", F.col("o_orderkey"))
    rates = """CASE WHEN k % 41 = 0 THEN NULL
                    WHEN k % 43 = 0 THEN cast(array() AS {rate_type})
                    ELSE transform(sequence(1, int(1 + k % 4)), i -> named_struct(
      'service_category', CASE (k + i) % 4 WHEN 0 THEN NULL WHEN 1 THEN ' lab'
                               WHEN 2 THEN lower(o_orderstatus) ELSE o_orderpriority END,
      'cpt_code', CASE WHEN (k + i) % 13 = 0 THEN NULL ELSE concat('X', (k * 7 + i) % 500, ' ') END,
      'description', CASE WHEN k % 2 = 0 THEN o_orderpriority END,
      'rate_type', CASE i WHEN 1 THEN 'per_diem' WHEN 2 THEN 'Percentage'
                          WHEN 3 THEN 'odd' ELSE NULL END,
      'rate_amount', cast(CASE WHEN (k + i) % 29 = 0 THEN NULL WHEN (k + i) % 31 = 0 THEN 0
                          WHEN i = 2 THEN k % 100 ELSE o_totalprice END AS decimal(12,2)),
      'effective_date', CASE WHEN i = 2 THEN 'null' WHEN i = 3 THEN ''
                             ELSE date_format(date_add(date(o_orderdate), i * 30), 'yyyy-MM-dd') END,
      'rate_unit', CASE WHEN i = 1 THEN ' visit' END,
      'modifier', CASE WHEN k % 9 = 0 THEN concat('M', i, ' ') END)) END"""
    amendments = """CASE WHEN k % 3 = 0 THEN transform(sequence(1, int(1 + k % 2)), i -> named_struct(
      'amendment_id', CASE WHEN k % 6 = 0 AND i = 1 THEN NULL ELSE concat('AMD-', i, ' ') END,
      'amendment_date', CASE WHEN k % 5 = 0 THEN ''
                             ELSE date_format(date_add(date(o_orderdate), 100 - i), 'yyyy-MM-dd') END,
      'description', concat(' change ', i),
      'rate_changes', o_orderpriority,
      'effective_date', cast(NULL AS string),
      'amendment_type', CASE WHEN k % 2 = 0 THEN 'extension' ELSE 'other' END)) END"""
    rate_type = RATE_SCHEDULE.simpleString()
    return orders.selectExpr(
        "concat('CON-', k) AS contract_id",
        "concat('Payer ', k % 7) AS payer_name",
        "CASE WHEN k % 37 = 0 THEN NULL ELSE concat('pay', k % 7) END AS payer_id",
        """CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN '12345'
                WHEN k % 67 = 0 THEN '12345678901' WHEN k % 71 = 0 THEN '12345abcde'
                ELSE lpad(string(o_custkey), 10, '0') END AS provider_npi""",
        "concat('Clinic', char(9), o_custkey) AS provider_name",
        """CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN 'null'
                ELSE date_format(o_orderdate, 'yyyy-MM-01') END AS effective_date""",
        """CASE WHEN k % 11 = 0 THEN NULL WHEN k % 23 = 0 THEN ''
                ELSE date_format(date_add(date(o_orderdate), int(k % 900)), 'yyyy-MM-dd') END
           AS termination_date""",
        rates.format(rate_type=f"array<{rate_type}>") + " AS rate_schedules",
        amendments + " AS amendments",
        """named_struct(
             'extracted_at', CASE WHEN k % 47 = 0 THEN NULL
                                  ELSE date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") END,
             'confidence_score', cast(CASE WHEN k % 53 = 0 THEN 1.5 ELSE (k % 101) / 100 END
                                      AS decimal(5,4)),
             'source_file', concat('incoming/', k, '.pdf'),
             'extractor_version', '1.0.0') AS extraction_metadata""",
    )


def reloaded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with every tenth one loaded a second time."""
    once = contract_documents(spark, folder)
    number = F.regexp_extract("contract_id", r"\d+", 0).cast("bigint")
    return once.unionByName(once.where(number % 10 == 0))


def contract_texts(spark: SparkSession, folder: str) -> DataFrame:
    """One document (text and tables) per order.

    Labels come and go with the order key, so that every extraction pattern,
    and every way of missing it, occurs.
    """
    joined = (
        spread(table(spark, folder, "orders"))
        .join(
            table(spark, folder, "customer").select(
                F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
            ),
            "o_custkey",
        )
        .withColumn("k", F.col("o_orderkey"))
    )
    date_text = """CASE {k} % 3 WHEN 0 THEN date_format({d}, 'M/d/yyyy')
                                WHEN 1 THEN date_format({d}, 'M-d-yy')
                                ELSE date_format({d}, 'yyyy-MM-dd') END"""
    start = date_text.format(k="k", d="o_orderdate")
    end = "date_format(date_add(date(o_orderdate), 730), 'MM/dd/yyyy')"
    lines = [
        """CASE k % 5 WHEN 0 THEN concat('Contract Number: CTR-', k)
                      WHEN 1 THEN concat('Agreement No AG-', k)
                      WHEN 2 THEN concat('CTR: ', k)
                      WHEN 3 THEN 'Contract Notice' ELSE 'No reference' END""",
        """CASE k % 7 WHEN 0 THEN 'Payer: Aetna' WHEN 1 THEN 'insurance: State Blue Cross'
                      WHEN 2 THEN 'covered by Humana only' WHEN 3 THEN 'Plan - Kaiser'
                      WHEN 4 THEN concat('Payer: ', lower(c_mktsegment), ' cigna')
                      ELSE 'self pay' END""",
        """CASE k % 4 WHEN 0 THEN concat('Provider: ', c_mktsegment, ' Medical Center')
                      WHEN 1 THEN concat('Facility: ', initcap(c_mktsegment), ' Clinic')
                      WHEN 2 THEN 'Provider: none' ELSE '' END""",
        """CASE WHEN k % 6 = 5 THEN 'NPI pending'
                ELSE concat('NPI: ', lpad(string(k), 10, '1'), CASE WHEN k % 9 = 0 THEN '77' ELSE '' END)
           END""",
        f"""CASE k % 8 WHEN 7 THEN 'undated'
                      WHEN 6 THEN concat('Effective ', date_format(o_orderdate, 'yyyy/M/d'))
                      WHEN 5 THEN concat('term begins: ', {start})
                      WHEN 4 THEN 'Effective Date: 13/45/2001'
                      WHEN 3 THEN concat('Effective Date: 1/2/', 60 + k % 20)
                      ELSE concat('Effective Date: ', {start}) END""",
        f"""CASE k % 5 WHEN 0 THEN concat('Termination Date: ', {end})
                      WHEN 1 THEN concat('expiration date ', {end})
                      WHEN 2 THEN concat('expires ', {end}) ELSE 'evergreen' END""",
        f"""CASE WHEN k % 3 = 0 THEN concat('Amendment No. 1: rate change effective: ',
                                            {start}, '. Terms of ', c_name) ELSE 'no change' END""",
        """CASE WHEN k % 6 = 0 THEN concat('AMENDMENT #2 extension for ', o_orderpriority) ELSE '' END""",
    ]
    text = "concat_ws(chr(10), " + ", ".join(lines) + ")"
    money = "concat('$', format_number(o_totalprice, 2))"
    tables = f"""CASE k % 4
      WHEN 0 THEN array(named_struct(
          'headers', array('Service Category', 'CPT Code', 'Rate', 'Type'),
          'rows', array(array(c_mktsegment, string(o_custkey), {money}, 'PER_DIEM'),
                        array(o_orderpriority, 'X1', 'N/A', 'PER_DIEM'),
                        array(o_orderpriority, 'X2', string(k)))))
      WHEN 1 THEN array(
          named_struct('headers', array('Service Code', 'Fee Type'),
                       'rows', array(array(c_mktsegment, '75.5'), array(c_mktsegment, '12d'))),
          named_struct('headers', array('Name', 'Phone'),
                       'rows', array(array(c_name, '555'))))
      WHEN 2 THEN array(named_struct(
          'headers', array('Code', 'Amount', 'Rate'),
          'rows', array(array('C1', '1', {money}), array('C2', '2', ''))))
      END"""
    return joined.selectExpr(
        "concat('incoming/', k, '.pdf') AS source_file", text + " AS text", tables + " AS tables"
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Queue messages about web page objects: plain, enveloped, foreign and broken ones."""
    key = """concat('incoming%2F', url_encode(url),
                    CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '+copy.pdf'
                                     WHEN 2 THEN '.txt' ELSE '.pdf' END)"""
    bucket = "CASE WHEN page_id % 5 = 0 THEN 'other' ELSE 'raw' END"
    record = f"""concat('{{"s3":{{"bucket":{{"name":"', {bucket}, '"}},"object":{{',
                        CASE WHEN page_id % 13 = 0 THEN '' ELSE concat('"key":"', {key}, '"') END,
                        '}}}}}}')"""
    body = f"""concat('{{"Records":[', {record}, ']}}')"""
    return table(spark, folder, "pages").selectExpr(
        f"""CASE WHEN page_id % 17 = 0 THEN '{{"Records": ['
                 WHEN page_id % 11 = 0 THEN '{{"Event":"test"}}'
                 WHEN page_id % 3 = 0 THEN to_json(named_struct('Message', {body}))
                 ELSE {body} END AS body"""
    )


def document_store(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of `contract_texts`, some without text; `late` ones arrive after the others.

    Words that many texts have where others have a number would be one contract id of them all.
    """
    text = F.replace("text", F.lit("Contract Notice"), F.lit("Notice"))
    number = F.regexp_extract("source_file", r"\d+", 0).cast("bigint")
    return contract_texts(spark, folder).select(
        "source_file",
        F.when(number % 31 != 6, text).alias("text"),
        "tables",
        (number % 29 == 4).alias("late"),
    )


def document_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages about the documents, up to three each; number of the message and its `body`.

    Some name objects of another bucket, of another kind or that nobody sent; some are wrapped,
    some broken.
    """
    key = """concat(CASE WHEN k % 13 = 5 THEN 'missing' ELSE 'incoming' END, '%2F', k,
                    CASE WHEN k % 11 = 3 THEN '.txt' ELSE '.pdf' END)"""
    record = f"""named_struct('s3', named_struct(
      'bucket', named_struct('name', CASE WHEN k % 10 = 7 THEN 'other' ELSE 'raw' END),
      'object', named_struct('key', {key})))"""
    records = (
        table(spark, folder, "orders")
        .withColumn("k", F.col("o_orderkey"))
        .selectExpr("k DIV 3 AS number", "k", f"{record} AS record")
        .groupBy("number")
        .agg(F.array_sort(F.collect_list(F.struct("k", "record"))).alias("found"))
    )
    event = "to_json(named_struct('Records', found.record))"
    return records.selectExpr(
        "number",
        f"""CASE WHEN number % 17 = 0 THEN concat('broken ', number, ' ', left({event}, 20))
                 WHEN number % 4 = 0 THEN to_json(named_struct('Message', {event}))
                 ELSE {event} END AS body""",
    )


def page_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as objects of different kinds, name and content; some of them are PDF by name."""
    return table(spark, folder, "pages").selectExpr(
        """concat('site=', page_id % 3, '/', page_id,
                  CASE page_id % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.pdf' ELSE '.html' END) AS name""",
        "cast(coalesce(html, '') AS binary) AS content",
    )
