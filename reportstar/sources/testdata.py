"""The raw feeds derived from the order/lineitem test tables. The rules are in FIXTURES.md;
every row of the tables takes part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.plans.texts import TEXT_KEY, digest, text_key
from reportstar.sources.raw import REPORT_COLUMNS, RawTables

NATIVE_PREFIX = "مورد "
# An adversary is a brand within a run of this many orders, so that no list of report ids
# is longer, and the number of adversaries grows with the data.
ORDERS_PER_CAMPAIGN = 1000
# Reports are written in slices of their orders, each from about so many bytes of the file of lines, so that the lines of
# one slice at a time are dealt. Every slice reads the tables again, so there are so many at most.
SLICE_BYTES, MOST_SLICES = 32 << 20, 4


def _joined(texts: Column, separator: str) -> Column:
    return F.array_join(F.sort_array(texts), separator)


def _list_of(c: Column, separator: str) -> Column:
    return _joined(F.collect_set(c), separator)


def _case(selector: Column, choices: dict[int, Column], default: Column | None = None) -> Column:
    result = F
    for value, choice in choices.items():
        result = result.when(selector == value, choice)
    return result.otherwise(default) if default is not None else result


def derive_raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    nation = table("nation")
    supplier = table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    part = table("part")
    # Nations are joined last: Spark takes a joined side to be as large as the product of its parts and would deal all
    # lines by supplier. Those of a report are joined when its lines are dealt, so that no names travel.
    nations = nation.select("n_nationkey", "n_name")
    lines = (
        table("lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
        .join(
            table("supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        )
        .join(part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    )
    orders, customer, documents = table("orders"), table("customer"), table("documents")
    written = table("lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    n = max(1, min(MOST_SLICES, round(int(written) / SLICE_BYTES)))
    pieces = documents.count()
    rest, own = _rest(orders, customer, lines, nations), _texts(orders, documents, pieces)
    return RawTables(
        rest.join(own, "key", "left").select(*REPORT_COLUMNS),
        _adversaries(lines.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))),
        _entities(supplier, table("region")),
        (rest, own),
        tuple(
            (
                _rest(_slice(orders, "o_orderkey", i, n), customer, _slice(lines, "l_orderkey", i, n), nations),
                _text_keys(_slice(orders, "o_orderkey", i, n), documents, pieces),
            )
            for i in range(n)
        ),
    )


def _slice(df: DataFrame, key: str, i: int, n: int) -> DataFrame:
    """The i-th of n, all rows of a key in one."""
    return df if n == 1 else df.filter(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(n)) == i)


def _block() -> Column:
    return F.floor(F.col("l_orderkey") / ORDERS_PER_CAMPAIGN)


def _campaign(brand: Column, block: Column) -> Column:
    return F.concat(brand, F.lit("-"), block.cast("string"))


def _named(keys: Column, prefix: str) -> Column:
    return F.transform(keys, lambda key: F.concat(F.lit(prefix), key.cast("string")))


def _own_text(key: Column, text: Column) -> dict[str, Column]:
    """What a report has of its document."""
    return {
        "description": F.when(key % 10 < 9, text),
        "actions": F.when(key % 8 == 1, text),
        "analysis": F.when(key % 8 == 5, text),
    }


def _with_document(orders: DataFrame, documents: DataFrame, pieces: int) -> DataFrame:
    """Every document is the text of some reports: their order keys modulo the number of documents. Only the keys of
    orders meet the documents."""
    keys = orders.select(F.col("o_orderkey").alias("key")).distinct()
    return keys.join(documents, F.col("key") % F.lit(pieces) == F.col("doc_id"))


def _texts(orders: DataFrame, documents: DataFrame, pieces: int) -> DataFrame:
    """The texts of reports by the key of the order."""
    met = _with_document(orders, documents.select("doc_id", "text"), pieces)
    return met.select("key", *(t.alias(c) for c, t in _own_text(F.col("key"), F.col("text")).items()))


def _text_keys(orders: DataFrame, documents: DataFrame, pieces: int) -> DataFrame:
    """Their keys, for which only digests of documents travel."""
    met = _with_document(orders, documents.select("doc_id", digest("text").alias("digest")), pieces)
    own = _own_text(F.col("key"), F.col("digest"))
    return met.select("key", text_key(own.__getitem__).alias(TEXT_KEY))


def _rest(orders: DataFrame, customer: DataFrame, lines: DataFrame, nations: DataFrame) -> DataFrame:
    """Reports without their texts, by the key of the order."""
    # Lines of an order are far apart, so sets gathered before the shuffle would move more bytes than the lines do. Keys are
    # gathered once and get their names afterwards.
    # Numbers go first: shuffle codecs find more in rows whose texts are side by side.
    dealt = lines.select("l_orderkey", "l_suppkey", "s_nationkey", "p_brand", "p_type").repartition("l_orderkey")
    named = dealt.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    gathered = named.groupBy("l_orderkey").agg(
        F.min("p_type").alias("threat_type"),
        F.collect_set("n_name").alias("nations"),
        F.collect_set("l_suppkey").alias("suppliers"),
        F.collect_set("p_brand").alias("brands"),
    )
    per_order = gathered.select(
        "l_orderkey",
        "threat_type",
        _joined(F.col("nations"), ", ").alias("country"),
        _joined(_named(F.col("suppliers"), "SUP-"), "|").alias("id_list"),
        _joined(_named(F.col("suppliers"), NATIVE_PREFIX), "|").alias("entity_names"),
        _joined(F.transform("brands", lambda brand: _campaign(brand, _block())), "|").alias("related_groups"),
    )
    key = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    dmy = F.date_format("o_orderdate", "dd/MM/yyyy")
    mdy = F.date_format("o_orderdate", "MM/dd/yyyy")
    # Prices are put into their class before the orders are dealt: they are the one column that does not repeat.
    classed = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_totalprice") >= 300000, F.lit("High"))
        .when(F.col("o_totalprice") >= 100000, F.lit("Medium"))
        .otherwise(F.lit("nul"))
        .alias("importance"),
    )
    return (
        classed.join(
            customer.select("c_custkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
            "left",
        )
        .join(per_order, key == F.col("l_orderkey"), "left")
        .select(
            key.alias("key"),
            F.concat(
                F.when(key % 50 == 0, F.lit("rpt-")).otherwise(F.lit("RPT-")), key.cast("string")
            ).alias("id"),
            F.when(F.col("o_orderstatus") == "P", F.lit("other"))
            .otherwise(F.lit("threat"))
            .alias("report_type"),
            F.concat(F.lit("Order "), key.cast("string")).alias("title"),
            _case(
                key % 6,
                {0: stamp, 1: F.concat(dmy, F.lit(" 00:00:00")), 2: dmy, 3: mdy, 4: F.lit(" ")},
                F.lit("not-a-date"),
            ).alias("creation_date"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"),
            dmy.alias("report_date"),
            F.concat(dmy, F.lit(" 06:30:00")).alias("updated_at"),
            _case(
                key % 7,
                {
                    0: F.lit("NULL"),
                    1: F.lower("o_orderpriority"),
                    2: F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")),
                },
                F.col("o_orderpriority"),
            ).alias("classification"),
            F.col("o_orderstatus").alias("evidence_type"),
            "importance",
            F.col("c_mktsegment").alias("observation_source"),
            "threat_type",
            "country",
            F.when(key % 5 == 1, F.lit(""))
            .when(key % 5 != 0, F.col("id_list"))
            .alias("entity_ids"),
            "entity_names",
            "related_groups",
        )
    )


def _adversaries(lines: DataFrame) -> DataFrame:
    """Keys are gathered as numbers and named afterwards. Lines without a brand are of one campaign, which has no name."""
    targets = F.when(F.col("l_quantity") >= 45, F.col("n_name"))
    block = F.when(F.col("p_brand").isNotNull(), _block())
    return (
        lines.filter(F.col("l_returnflag") == "R")
        .groupBy("p_brand", block.alias("block"))
        .agg(
            _joined(_named(F.collect_set("l_orderkey"), "RPT-"), "|").alias("report_ids"),
            _list_of(targets, "|").alias("targets"),
        )
        .withColumn("campaign", _campaign(F.col("p_brand"), F.col("block")))
        .select(
            F.when(F.col("p_brand").endswith("5"), F.col("campaign"))
            .otherwise(F.upper("campaign"))
            .alias("adversary_id"),
            F.concat(F.lit("Actor "), F.col("campaign")).alias("adversary"),
            "report_ids",
            F.when(F.col("p_brand").endswith("7"), F.lit(""))
            .otherwise(F.col("targets"))
            .alias("targeted_country"),
        )
    )


def _entities(supplier: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    text = key.cast("string")
    return supplier.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(key % 10 != 9, F.concat(F.lit(" SUP-"), text)).alias("registry_id"),
        F.when(key % 4 == 0, F.lit("NULL"))
        .otherwise(F.concat(F.lit("PRM-"), text))
        .alias("alt_id"),
        F.when(key % 13 == 0, F.lit("nul")).otherwise(F.col("s_name")).alias("name_en"),
        F.concat(F.lit(NATIVE_PREFIX), text).alias("name_native"),
        F.col("n_name").alias("country"),
        F.when(F.col("s_acctbal") < 0, F.lit("NULL"))
        .otherwise(F.lit("Supplier"))
        .alias("category"),
        F.col("r_name").alias("sector"),
        F.lit("Org").alias("entity_type"),
        F.lit(None).cast("string").alias("domain"),
    )
