"""The driver's star-schema tables seen as retail lines, marketplace tables, reviews and events.

Every row of the driver's tables is used. Codes, dates and defects that the star schema lacks follow
from key arithmetic, so the same rows can be written down in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Stock codes that are not plain products, by remainder of the part key.
SPECIAL_CODES = [
    "POST", "DOT", "D", "M", "m", "BANK CHARGES", "gift_0001_10", "DCGS0003", "S", "C3",
    " 22423 ", "AMAZONFEE", "B", "ADJUST", "PADS", "\t20007A", "20012\n",
]
SPECIAL_MODULUS = 211
WHOLESALE = 9_000_000_000_000
NAMED_COUNTRIES = ["United Kingdom", "Germany", "France", "EIRE"]

# Review titles, by remainder of a row number; the rest of the remainders have no title.
REVIEW_TITLES = [
    "Ruim.",
    "ok",
    "Produto chegou quebrado, embalagem rasgada. Péssimo!",
    "Ainda não recebi meu pedido e o vendedor não respondeu minhas mensagens.",
    "Atraso na entrega",
    "<b>Quero o reembolso</b> ou a troca",
    "Muito bom",
    "péssima qualidade",
    "Faltou uma peça",
    "Boleto cobrado duas vezes, veja www.exemplo.com/boleto",
    "A transportadora perdeu o pacote",
    "Veio errado",
    "Não gostei",
    "mas também",
]
TITLE_MODULUS = 40

STATUS_BY_EVENT = {
    "signup": "created",
    "click": "paid",
    "view": "shipped",
    "purchase": "delivered",
    "error": "canceled",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """values[index], null beyond the end."""
    return F.get(F.array([F.lit(v) for v in values]), index.cast("int"))


def minutes(count: Column) -> Column:
    return F.make_dt_interval(mins=count.cast("int"))


def days(count: Column) -> Column:
    return F.make_dt_interval(days=count.cast("int"))


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail lines, one per line item."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Customers meet the orders before these meet the far more numerous items. Columns come from the items where they can,
    # so a filter on them reaches the scan.
    buyers = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    bought = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    rows = li.join(bought, li.l_orderkey == bought.o_orderkey).join(part, li.l_partkey == part.p_partkey)

    key, line, part_key = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    cancelled = F.col("l_returnflag") == "R"
    bad_debt = ~cancelled & (key % 1000 == 7)
    zero_price = ~cancelled & ((part_key + line) % 53 == 0)
    loss = zero_price & (F.col("l_returnflag") == "N")
    bulk = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    size = F.when(bulk, F.floor(F.col("l_extendedprice") / 10)).otherwise(
        F.ceil(F.col("l_quantity") / 10)
    )
    negative = (cancelled & (key % 331 != 5)) | loss
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    list_price = F.floor(unit / 4000).cast("double") * 4.0 + 0.95
    code = F.coalesce(
        pick(SPECIAL_CODES, part_key % SPECIAL_MODULUS),
        F.concat(
            (20000 + part_key).cast("string"), F.when(part_key % 5 == 0, "A").otherwise("")
        ),
    )
    # A tenth of the customers are wholesalers with one running invoice, so there are large baskets.
    basket = F.when(F.col("o_custkey") % 10 == 3, WHOLESALE + F.col("o_custkey")).otherwise(key)
    columns = {
        "Invoice": F.concat(
            F.when(cancelled, "C").when(bad_debt, "A").otherwise(""), basket.cast("string")
        ),
        "StockCode": code,
        "Quantity": F.when(negative, -size).otherwise(size).cast("bigint"),
        "InvoiceDate": F.col("o_orderdate") + minutes((key * 37) % 1440),
        "Price": F.when(zero_price, 0.0)
        .when(bad_debt & (line <= 4), -list_price)
        .otherwise(list_price),
        "Customer ID": F.when((key % 9 == 0) | ((key % 50 == 1) & (line == 6)), None)
        .when(F.col("o_custkey") % 101 == 0, F.concat(F.lit("guest-"), F.col("o_custkey")))
        .otherwise(F.concat(F.col("o_custkey"), F.when(key % 2 == 0, ".0").otherwise(""))),
        "Description": F.when((code == "C3") | (zero_price & (F.col("l_suppkey") % 4 == 0)), None)
        .when(loss & (line % 2 == 1), "damaged")
        .when(loss, "Lost ")
        .otherwise(F.col("p_type")),
        "Country": F.coalesce(pick(NAMED_COUNTRIES, F.col("n_nationkey")), F.col("n_name")),
    }
    return rows.select([columns[f.name].alias(f.name) for f in schemas.RETAIL])


def marketplace(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine marketplace tables."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    key = F.col("o_orderkey")
    state = key % 20
    status = (
        F.when(state == 0, "canceled")
        .when(state == 1, "unavailable")
        .when(state == 2, "shipped")
        .when(state == 3, "invoiced")
        .when(state == 4, "processing")
        .when(state == 5, "created")
        .when(state == 6, "approved")
        .otherwise("delivered")
    )
    bought = F.col("o_orderdate") + minutes((key * 37) % 1440)
    arrived = bought + days(3 + key % 17) + F.make_dt_interval(secs=(key * 7919) % 86400)
    orders = o.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        F.when(state != 5, bought + minutes(F.lit(60))).alias("order_approved_at"),
        F.when((state > 6) | (state == 2), bought + days(F.lit(2))).alias(
            "order_delivered_carrier_date"
        ),
        F.when((state > 6) & (key % 97 != 8), arrived).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + days(8 + key % 13)).alias("order_estimated_delivery_date"),
    )

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_shipdate",
    )
    items = li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("l_quantity") * 1.25).cast("decimal(12,2)").alias("freight_value"),
    )

    copies = F.array_repeat(F.lit(1), (key % 3).cast("int"))
    reviews = o.select("o_orderkey", "o_orderdate", F.posexplode(copies).alias("pos", "one"))
    reviews = reviews.withColumn("n", F.col("pos") + 1).select(
        F.concat_ws("-", key.cast("string"), F.col("n").cast("string")).alias("review_id"),
        key.cast("string").alias("order_id"),
        (1 + (key * 7 + F.col("n") * 3) % 5).cast("int").alias("review_score"),
        F.when(key % 4 == 0, F.concat(F.lit('nota "'), F.col("n"), F.lit('"'))).alias(
            "review_comment_title"
        ),
        F.when(key % 5 != 0, F.concat(F.lit("pedido "), key, F.lit("\n, fim"))).alias(
            "review_comment_message"
        ),
        (F.col("o_orderdate") + days(F.lit(20))).alias("review_creation_date"),
        (F.col("o_orderdate") + days(20 + F.col("n"))).alias("review_answer_timestamp"),
    )

    p, pk = table(spark, sf_dir, "part"), F.col("p_partkey")
    products = p.select(
        pk.cast("string").alias("product_id"),
        F.when(pk % 50 != 0, F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") * 10).alias("product_description_lenght"),
        (pk % 6).cast("int").alias("product_photos_qty"),
        *[
            (F.col("p_size") * n).cast("int").alias(f"product_{c}")
            for n, c in enumerate(["weight_g", "length_cm", "height_cm", "width_cm"], start=1)
        ],
    )
    translation = (
        p.select(F.lower("p_type").alias("product_category_name"))
        .where(F.col("product_category_name") != "promo")
        .distinct()
        .withColumn(
            "product_category_name_english",
            F.when(F.col("product_category_name") != "large", F.initcap("product_category_name")),
        )
    )

    # One name is written with a combining tilde.
    cities = ["São Paulo", "sao bernardo", "SÃO JOSÉ", "Rio de Janeiro", "Curitiba", "Sa\u0303o Vicente"]
    ck = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(
        ck.cast("string").alias("customer_id"),
        F.concat(F.lit("u"), ck).alias("customer_unique_id"),
        F.lpad((ck % 100000).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        pick(cities, ck % 6).alias("customer_city"),
        F.concat(F.lit("S"), F.col("c_nationkey")).alias("customer_state"),
    )
    sk = F.col("s_suppkey")
    sellers = table(spark, sf_dir, "supplier").select(
        sk.cast("string").alias("seller_id"),
        F.lpad((sk % 100000).cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        pick(cities, sk % 6).alias("seller_city"),
        F.concat(F.lit("S"), F.col("s_nationkey")).alias("seller_state"),
    )
    payments = o.select(
        key.cast("string").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.when(key % 4 == 0, "boleto").otherwise("credit_card").alias("payment_type"),
        (1 + key % 10).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("payment_value"),
    )
    geolocation = table(spark, sf_dir, "customer").select(
        F.lpad((ck % 100000).cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (ck % 180 - 90).cast("double").alias("geolocation_lat"),
        (ck % 360 - 180).cast("double").alias("geolocation_lng"),
        pick(cities, ck % 6).alias("geolocation_city"),
        F.concat(F.lit("S"), F.col("c_nationkey")).alias("geolocation_state"),
    )
    return {
        "orders": orders,
        "order_items": items,
        "order_reviews": reviews,
        "products": products,
        "customers": customers,
        "sellers": sellers,
        "order_payments": payments,
        "geolocation": geolocation,
        "product_category_name_translation": translation,
    }


def served_snapshot(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same tables as a warehouse might show them: some orders have not arrived, one day a month is
    missing, some statuses and reviews are not up to date."""
    orders, key = tables["orders"], F.col("order_id").cast("bigint")
    return {
        "orders": orders.where((key % 37 != 0) & (F.dayofmonth("order_purchase_timestamp") != 13)).withColumn(
            "order_status", F.when(key % 41 == 0, "canceled").otherwise(F.col("order_status"))
        ),
        "order_items": tables["order_items"],
        "order_reviews": tables["order_reviews"].where(key % 29 != 0),
    }


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_reviews(table(spark, sf_dir, "documents"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def document_reviews(documents: DataFrame) -> DataFrame:
    """Customer reviews: each line of each document is one, and each document adds a mere rating."""
    lines = documents.select(
        "doc_id", F.posexplode(F.array_append(F.split("text", "\n"), F.lit(None).cast("string")))
        .alias("line", "message")
    )
    turn = F.col("doc_id") * 7 + F.col("line") * 3
    return lines.select(
        F.concat_ws("-", F.col("doc_id").cast("string"), F.col("line").cast("string")).alias(
            "review_id"
        ),
        F.col("doc_id").cast("string").alias("order_id"),
        (1 + (F.col("doc_id") + F.col("line")) % 5).cast("int").alias("review_score"),
        F.when(F.col("message").isNotNull(), pick(REVIEW_TITLES, turn % TITLE_MODULUS)).alias(
            "review_comment_title"
        ),
        F.col("message").alias("review_comment_message"),
    )


def order_events(events: DataFrame) -> DataFrame:
    """Order status events out of the raw event table; some arrive twice, some are unreadable."""
    k = F.get_json_object("props", "$.k").cast("int")
    order = F.col("user_id") * 10 + k % 10
    status = F.coalesce(*[F.when(F.col("event_type") == e, s) for e, s in STATUS_BY_EVENT.items()])
    due = F.lit("2024-01-03").cast("timestamp") + days(order % 25)
    fields = {
        "order_id": order.cast("string"),
        "seller_id": F.col("user_id").cast("string"),
        "status": status,
        "version": F.col("event_id"),
        "estimated_delivery_date": F.date_format(due, "yyyy-MM-dd HH:mm:ss"),
        "amount": F.col("value").cast("decimal(12,2)"),
    }
    message = F.to_json(F.named_struct(*[x for name, c in fields.items() for x in (F.lit(name), c)]))
    sent = events.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("k") == 99, F.substring("props", 1, 5)).otherwise(message).alias("payload"),
        F.array_repeat(F.lit(1), F.when(F.col("k") < 10, 2).otherwise(1)).alias("copies"),
    )
    return sent.select("event_id", "event_time", "payload", F.explode("copies").alias("copy"))


def model_answers(texts: DataFrame) -> DataFrame:
    """Answers of both models to every text, with all defects an answer can have.

    The defect follows from a hex digit of the text key: the first for the small model, the second
    for the large one.
    """
    tiers = F.explode(
        F.array(
            *[
                F.struct(F.lit(tier).alias("tier"), (F.instr(F.lit("0123456789abcdef"), F.substring("dedup_key", n, 1)) - 1).alias("kind"))
                for n, tier in ((1, "small"), (2, "large"))
            ]
        )
    )
    kind = F.col("kind")

    def issue(category: str, subcategory: str, evidence: Column, confidence: Column) -> Column:
        return F.struct(
            F.lit(category).alias("category"),
            F.lit(subcategory).alias("subcategory"),
            evidence.alias("evidence"),
            confidence.alias("confidence"),
        )

    said = F.substring("raw_text", 1, 30)
    plain = issue(
        "delivery",
        "delay",
        F.when(kind == 4, "texto que não existe aqui").otherwise(said),
        F.when(kind == 2, 1.2).when(kind == 5, 0.69).otherwise(0.9),
    )
    issues = (
        F.when(kind == 1, F.array(issue("weather", "delay", said, F.lit(0.9))))
        .when(kind == 3, F.array_remove(F.array(plain), plain))
        .when(kind == 7, F.array(plain, issue("product", "defective", F.lower(said), F.lit(0.8))))
        .otherwise(F.array(plain))
    )
    answer = F.to_json(F.struct(issues.alias("issues"), (kind == 15).alias("needs_manual_review")))
    return (
        texts.where(F.col("route") != "rule")
        .select("dedup_key", "raw_text", tiers.alias("t"))
        .select("dedup_key", "raw_text", "t.*")
        .select(
            "dedup_key",
            "tier",
            F.when(kind == 0, F.lit('{"issues": [')).when(kind != 6, answer).alias("raw_json"),
        )
    )


def judged_reviews(labels: DataFrame) -> DataFrame:
    """Human judgements made of the label table."""
    doc = F.col("doc_id")
    issues = (1 + doc % 3).cast("bigint")
    return labels.select(
        (1 + doc % 3).cast("int").alias("batch"),
        pick(["rule", "small_llm", "large_llm"], (doc / 3).cast("bigint") % 3).alias("method"),
        F.col("quality").cast("bigint").alias("class_ok"),
        issues.alias("issues"),
        (issues - F.col("toxic")).alias("issues_supported"),
        F.col("toxic").cast("bigint").alias("issues_invented"),
        (1 + doc % 2).cast("bigint").alias("true_issues"),
        (1 - F.col("quality")).cast("bigint").alias("missed_issues"),
        (1 - F.col("toxic")).cast("bigint").alias("actionable_ok"),
    )
