"""Feature operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace import scratch
from millrace.ml import features, models, scoring
from millrace.plans import feature_job
from millrace.queries.registry import query, table, texts

# The default English stop words of the feature library.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
_STOPS_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

# Trailing empty tokens do not exist: white space at the end is cut before splitting.
_TOKENS = r"""
    SELECT doc_id, unnest(regexp_split_to_array(
             regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]')) AS term
    FROM documents"""


@query("feat_tokens", f"SELECT term, count(*) AS n FROM ({_TOKENS}) GROUP BY term")
def feat_tokens(spark, sf_dir):
    docs = texts(spark, sf_dir, "text")
    terms = features.tokenizer("text", "terms").transform(docs)
    return terms.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n")
    )


@query("feat_nostops", f"""
    SELECT term, count(*) AS n FROM ({_TOKENS}) WHERE term NOT IN ({_STOPS_SQL}) GROUP BY term""")
def feat_nostops(spark, sf_dir):
    docs = texts(spark, sf_dir, "text")
    terms = features.tokenizer("text", "terms").transform(docs)
    kept = features.stop_words_remover("terms", "kept").transform(terms)  # the default list
    return kept.select(F.explode("kept").alias("term")).groupBy("term").agg(
        F.count("*").alias("n")
    )


@query("feat_count_vec", """
    WITH w AS (SELECT p_partkey, unnest(string_split(trim(p_name), ' ')) AS term FROM part),
    top AS (SELECT term FROM w GROUP BY term HAVING count(DISTINCT p_partkey) >= 2
            ORDER BY count(*) DESC, term LIMIT 2)
    SELECT p_partkey, term, CAST(count(*) AS DOUBLE) AS uses
    FROM w JOIN top USING (term) GROUP BY ALL""")
def feat_count_vec(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.split(F.trim("p_name"), " ").alias("terms")
    )
    model = features.count_vectorizer(part, "terms", "counts", size=2, min_df=2)
    names = F.array(*[F.lit(w) for w in model.vocabulary])
    long = model.transform(part).select(
        "p_partkey",
        F.inline(F.arrays_zip(names.alias("term"), vector_to_array("counts").alias("uses"))),
    )
    return long.where("uses > 0")


@query("feat_word2vec", "SELECT p_partkey, p_name, true AS is_mean FROM part")
def feat_word2vec(spark, sf_dir):
    """Whether each part's vector is the mean of its words' vectors."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    terms = features.tokenizer("p_name", "terms").transform(part)
    model = features.word_vectors(terms, "terms", "vector")
    words = features.vector_columns(model.getVectors(), "vector", ["w0", "w1"]).select("word", "w0", "w1")
    means = terms.select("p_partkey", F.explode("terms").alias("word")).join(words, "word").groupBy("p_partkey").agg(
        F.avg("w0").alias("m0"), F.avg("w1").alias("m1"))
    own = features.vector_columns(model.transform(terms), "vector", ["v0", "v1"])
    near = (F.abs(F.col("v0") - F.col("m0")) < 1e-5) & (F.abs(F.col("v1") - F.col("m1")) < 1e-5)
    return own.join(means, "p_partkey").select("p_partkey", "p_name", near.alias("is_mean"))


_SEGMENTS = """
    WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
    i AS (SELECT segment, CAST(row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS DOUBLE) AS idx
          FROM c WHERE segment IS NOT NULL GROUP BY segment)"""


def _segments(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return features.string_index(customer, "segment", "idx").transform(customer)


@query("feat_string_index", _SEGMENTS + """
    SELECT c_custkey, segment, idx FROM c JOIN i USING (segment)""")
def feat_string_index(spark, sf_dir):
    return _segments(spark, sf_dir)


@query("feat_one_hot", _SEGMENTS + """
    SELECT c_custkey, CAST(idx = 0 AS INTEGER)::DOUBLE AS s0, CAST(idx = 1 AS INTEGER)::DOUBLE AS s1,
           CAST(idx = 2 AS INTEGER)::DOUBLE AS s2
    FROM c JOIN i USING (segment)""")
def feat_one_hot(spark, sf_dir):
    indexed = _segments(spark, sf_dir)
    hot = features.one_hot("idx", "hot").fit(indexed).transform(indexed)
    return features.vector_columns(hot, "hot", ["s0", "s1", "s2"]).select(
        "c_custkey", "s0", "s1", "s2"
    )


@query("feat_binarize", """
    SELECT l_orderkey, l_partkey, CASE WHEN l_quantity > 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high
    FROM lineitem""")
def feat_binarize(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return features.binarizer("l_quantity", "high", 10.0).transform(rows).drop("l_quantity")


@query("feat_month_index", """
    WITH m AS (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders),
    i AS (SELECT month, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(month AS VARCHAR)) - 1 AS DOUBLE) AS idx
          FROM m GROUP BY month)
    SELECT o_orderkey, month, idx FROM m JOIN i USING (month)""")
def feat_month_index(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.month("o_orderdate").alias("month")
    )
    return features.string_index(months, "month", "idx").transform(months)


def _assembled(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    return features.assembler(["l_quantity", "l_extendedprice", "l_discount"], "features").transform(
        rows
    )


@query("feat_assemble", """
    SELECT l_orderkey, l_partkey, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2
    FROM lineitem""")
def feat_assemble(spark, sf_dir):
    return features.vector_columns(_assembled(spark, sf_dir), "features", ["f0", "f1", "f2"]).select(
        "l_orderkey", "l_partkey", "f0", "f1", "f2"
    )


@query("feat_scale", """
    WITH s AS (SELECT stddev_samp(l_quantity) AS a, stddev_samp(l_extendedprice) AS b FROM lineitem)
    SELECT l_orderkey, l_partkey, round(l_quantity / a, 6) AS f0, round(l_extendedprice / b, 6) AS f1
    FROM lineitem, s""")
def feat_scale(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    scaled = features.scaler("features", "scaled").fit(rows).transform(rows)
    return features.vector_columns(scaled, "scaled", ["f0", "f1"]).select(
        "l_orderkey", "l_partkey", F.round("f0", 6).alias("f0"), F.round("f1", 6).alias("f1")
    )


def _chi_square(feature: str) -> str:
    """SQL: the statistic of one feature, n * (sum of observed^2 / (row * column) - 1)."""
    return f"""
      SELECT '{feature}' AS feature, sum(n) * (sum(n * n / (r * c)) - 1) AS statistic
      FROM (SELECT n, sum(n) OVER (PARTITION BY f) AS r, sum(n) OVER (PARTITION BY label) AS c
            FROM (SELECT {feature} AS f, label, CAST(count(*) AS DOUBLE) AS n FROM o GROUP BY ALL))"""


@query("feat_chisq", f"""
    WITH o AS (
      SELECT CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
             CAST(month(o_orderdate) AS DOUBLE) AS month,
             CASE WHEN o_totalprice > 200000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dear,
             CASE WHEN o_totalprice > 250000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
      FROM orders),
    best AS (
      SELECT feature FROM ({_chi_square('priority')} UNION ALL {_chi_square('month')}
        UNION ALL {_chi_square('dear')})
      ORDER BY statistic DESC LIMIT 1)
    SELECT feature, CASE feature WHEN 'priority' THEN priority WHEN 'month' THEN month ELSE dear END AS value,
           label, count(*) AS n
    FROM o, best GROUP BY ALL""")
def feat_chisq(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.when(F.col("o_totalprice") > 200000, 1.0).otherwise(0.0).alias("dear"),
        F.when(F.col("o_totalprice") > 250000, 1.0).otherwise(0.0).alias("label"),
    )
    names = ["priority", "month", "dear"]
    vectors = features.assembler(names, "features").transform(rows)
    model = features.chi_square_selector("features", "label", "chosen").fit(vectors)
    kept = features.vector_columns(model.transform(vectors), "chosen", ["value"])
    name = F.array(*[F.lit(names[i]) for i in model.selectedFeatures])[0]
    return kept.groupBy(name.alias("feature"), "value", "label").agg(F.count("*").alias("n"))


@query("feat_slice", "SELECT l_orderkey, l_partkey, l_extendedprice AS f1 FROM lineitem")
def feat_slice(spark, sf_dir):
    sliced = features.slicer("features", "one", [1]).transform(_assembled(spark, sf_dir))
    return features.vector_columns(sliced, "one", ["f1"]).select("l_orderkey", "l_partkey", "f1")


def retail_rows(spark, sf_dir):
    """Order lines in the shape of enriched retail rows (text dates, text numbers)."""
    # some lines come twice, the second time with a larger quantity; some once more without an
    # age; some weights are no numbers
    number = F.col("l_quantity").cast("int")
    again = F.when(number < 5, F.array(F.lit(0), F.lit(1))).when(number > 45, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    lines = table(spark, sf_dir, "lineitem").withColumn("again", F.explode(again)).select(
        F.col("l_orderkey").alias("invoice_num"), F.col("l_partkey").alias("stock_code"),
        F.when(F.col("again") == 1, number + 100).when(F.col("again") == 2, 0).otherwise(number).alias("quantity"),
        F.date_format("l_shipdate", "dd/M/yy HH:mm").alias("invoice_date"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity") / 100, 2).alias("unit_price"),
        F.when(F.col("again") < 2, F.col("l_suppkey").cast("string")).alias("age"),
        F.col("l_tax").cast("string").alias("final_weight"),
        F.col("l_returnflag").alias("gender"), F.col("l_linestatus").alias("occupation"),
        "l_suppkey",
    )
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name AS description")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name AS country_code")
    bad = F.when(F.col("final_weight") == "0.05", "five").otherwise(F.col("final_weight"))
    lines = lines.withColumn("final_weight", bad)
    return (
        lines.join(part, F.col("stock_code") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .drop("p_partkey", "l_suppkey", "s_suppkey", "s_nationkey", "n_nationkey")
    )


def wrangled_rows(spark, sf_dir):
    return feature_job.wrangle(
        retail_rows(spark, sf_dir),
        keys=("invoice_num", "invoice_date", "stock_code"),
        order=("quantity", "unit_price", "final_weight", "gender", "occupation", "age"),
        floats={"cust_age": "age", "fin_wt": "final_weight"},
        time_text="invoice_date", time="invoice_time", pattern="dd/M/yy HH:mm",
        required=("age", "description"),
    )


@query("wrangle", """
    SELECT l_orderkey AS invoice_num, l_partkey AS stock_code, n_name AS country_code,
           CAST(l_quantity AS INTEGER) AS quantity, p_name AS description,
           CAST(l_suppkey AS FLOAT) AS cust_age, CAST(CASE WHEN l_tax = 0.05 THEN 0 ELSE l_tax END AS FLOAT) AS fin_wt,
           make_timestamp(2000 + (year(l_shipdate) % 100), month(l_shipdate), day(l_shipdate),
                          hour(l_shipdate), minute(l_shipdate), 0) AS invoice_time
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey""")
def wrangle(spark, sf_dir):
    return wrangled_rows(spark, sf_dir).select(
        "invoice_num", "stock_code", "country_code", "quantity", "description", "cust_age",
        "fin_wt", F.col("invoice_time").cast("timestamp_ntz").alias("invoice_time"),
    )


def job_rows(spark, sf_dir):
    """All wrangled rows with the columns that the features and the results take: the job stores its
    rows, and behind a store Catalyst cannot leave out the others."""
    return wrangled_rows(spark, sf_dir).select(
        "invoice_num", "stock_code", "country_code", "quantity", "description", "unit_price", "invoice_time")


@query("feature_pipeline", """
    WITH r AS (
      SELECT l_orderkey AS invoice_num, l_partkey AS stock_code, n_name AS country,
             CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, CAST(month(l_shipdate) AS VARCHAR) AS month,
             CAST(round(l_extendedprice / l_quantity / 100, 2) > 10 AS INTEGER)::DOUBLE AS binarized_price
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
    c AS (SELECT country, CAST(row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS DOUBLE) AS country_indexed FROM r GROUP BY country),
    q AS (SELECT quantity, CAST(row_number() OVER (ORDER BY count(*) DESC, quantity) - 1 AS DOUBLE) AS quantity_indexed FROM r GROUP BY quantity),
    m AS (SELECT month, CAST(row_number() OVER (ORDER BY count(*) DESC, month) - 1 AS DOUBLE) AS month_indexed FROM r GROUP BY month)
    SELECT invoice_num, stock_code, country_indexed, quantity_indexed, binarized_price, month_indexed, true AS scaled
    FROM r JOIN c USING (country) JOIN q USING (quantity) JOIN m USING (month)""")
def feature_pipeline(spark, sf_dir):
    out = feature_job.build_features(job_rows(spark, sf_dir))
    raw, scaled = (features.vector_to_array(c) for c in ("features", "scaled_features"))
    one = features.vector_to_array("selected_features")
    return out.select(
        "invoice_num", "stock_code", "country_indexed", "quantity_indexed", "binarized_price",
        "month_indexed", ((F.size(raw) == F.size(scaled)) & (F.get(scaled, 1) == F.get(one, 0))).alias("scaled"),
    )


_TRAIN = "l_orderkey % 3 > 0"


@query("feature_job_model", f"""
    WITH r AS (
      SELECT l_orderkey, l_partkey, n_name AS country, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
             CAST(month(l_shipdate) AS VARCHAR) AS month, CAST(round(l_extendedprice / l_quantity / 100, 2) > 10 AS INTEGER)::DOUBLE AS binarized_price
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
    t AS (SELECT * FROM r WHERE {_TRAIN}),
    c AS (SELECT country, CAST(row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS DOUBLE) AS country_indexed FROM t GROUP BY country),
    q AS (SELECT quantity, CAST(row_number() OVER (ORDER BY count(*) DESC, quantity) - 1 AS DOUBLE) AS quantity_indexed FROM t GROUP BY quantity),
    m AS (SELECT month, CAST(row_number() OVER (ORDER BY count(*) DESC, month) - 1 AS DOUBLE) AS month_indexed FROM t GROUP BY month),
    s AS (SELECT stddev_samp(month_indexed) AS d FROM t JOIN m USING (month) JOIN c USING (country) JOIN q USING (quantity))
    SELECT l_orderkey AS invoice_num, l_partkey AS stock_code, country_indexed, quantity_indexed, binarized_price, month_indexed,
           round(month_indexed / d, 6) AS scaled_month, (SELECT count(*) FROM c) + 4 AS width
    FROM r JOIN c USING (country) JOIN q USING (quantity) JOIN m USING (month), s WHERE NOT {_TRAIN}""")
def feature_job_model(spark, sf_dir):
    """The feature job fitted on two thirds of the orders, saved, loaded, and applied to the others."""
    rows = models.prepared(job_rows(spark, sf_dir))
    model = feature_job.fit_features(rows.where("invoice_num % 3 > 0"))
    path = scratch.new_path(spark, "feature-job")
    scoring.save_model(model, path)
    out = scoring.load_model(path).transform(rows.where("invoice_num % 3 = 0"))
    scaled = features.vector_to_array("scaled_features")
    return out.select(
        "invoice_num", "stock_code", "country_indexed", "quantity_indexed", "binarized_price", "month_indexed",
        F.round(F.get(scaled, F.size(scaled) - 2), 6).alias("scaled_month"), F.size(scaled).cast("bigint").alias("width"))


@query("feature_table", """
    SELECT l_orderkey, l_partkey, CAST(month(l_shipdate) AS INTEGER) AS month,
           CASE WHEN l_quantity > 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high
    FROM lineitem""")
def feature_table(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.month("l_shipdate").alias("month"), "l_quantity"
    )
    frame = features.binarizer("l_quantity", "high", 10.0).transform(rows).drop("l_quantity")
    return feature_job.save_features(
        frame, scratch.work_database(spark), scratch.new_name("retail_features"),
        scratch.new_path(spark, "features"),
    )
