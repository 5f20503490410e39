"""Line dedup by a log-template tree, in DataFrame functions only.

A line's tokens stand between white space; tokens with a digit count as a variable field.  The
tree has a fixed depth: the number of tokens, then the first ``LEADING`` tokens, lead to a
leaf, and ``LEVELS`` further splits to the groups of a leaf.  A split goes by the position at which
one token is most common among the group's distinct lines (but not in all); tokens with a share of
``SHARE`` there lead to a group of their own each, all others stay together.  So several templates
of a leaf part, however many copies any line has.  In a group of several lines, a token that all
have at its position is constant, others are variable fields; if at least ``SIMILARITY`` of the
tokens are constant, the group is a template.  Besides, every line is a template of its own.

A template in ``MIN_DOCS`` documents or more recurs, and so does a line of ``LONG`` tokens or more
that stands word by word in two.  Its lines are dropped from all documents but the one with the
smallest doc_id.  Lines of up to ``LEADING`` tokens have a leaf each, so they recur as they are.

Empty lines stay.  A line that repeats inside one document only is not dropped.  A null text stays
null and has no lines; a text that loses all its lines becomes empty.  Rows with a null doc_id
count as one document, and are the first one only if there is no other.  Rows that repeat a
doc_id are one document and lose lines each on their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.scratch import keep

LEADING = 3
MIN_DOCS = 5
LONG = 8
LEVELS = 3
SHARE = 0.1
SIMILARITY = 0.75
FIELD = "<*>"
#: Size of the leaf filter, and of one of the maps that it is put together from.
FILTER_BITS = 22
MAP_BYTES = 4096
BLANKS = "[ \\t\\r\\f\\x0B]+"


def masked(line: Column) -> Column:
    """A line of tokens joined by one space, with its variable fields as ``FIELD``."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def needed(n: Column) -> Column:
    """In how many documents a line of n tokens recurs."""
    return F.when(n >= LONG, 2).otherwise(MIN_DOCS)


def _even(text: Column) -> Column:
    """One space wherever blanks stand."""
    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in ("  ", "\t", "\r", "\f", "\x0b")])
    return F.when(odd, F.regexp_replace(text, BLANKS, " ")).otherwise(text)


def _lines() -> Column:
    """Array of (pos, line (masked), n, lead, slot) of a text's lines that are not empty.  Step by step in arrays, so that each step is computed once a line; later
    filters on columns would repeat them."""
    lines = F.transform(F.transform(F.split(_even(F.col("text")), "\n"), F.trim), masked)

    def parsed(line: Column, pos: Column) -> Column:
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        return F.struct(pos.alias("pos"), line.alias("line"), n.alias("n"), F.xxhash64(F.substring_index(line, " ", LEADING)).alias("lead"))

    some = F.filter(F.transform(lines, parsed), lambda x: x["line"] != "")
    return F.transform(some, lambda x: x.withField("slot", F.pmod(F.xxhash64(x["n"], x["lead"]), F.lit(1 << FILTER_BITS))))


def _crowded(docs: DataFrame) -> bytes:
    """Bitmap of the slots of leaves that hold as many lines as it takes to recur.

    It has ``FILTER_BITS`` hash values, so half a MB whatever the input; that is what reaches the
    driver and the tasks.  It lets some lines of other leaves through, and loses none.
    """
    leaves = docs.select(F.explode(_lines()).alias("x")).groupBy("x.n", "x.lead").agg(F.count("*").alias("all"), F.first("x.slot").alias("slot"))
    slots = leaves.where(F.col("all") >= needed(F.col("n"))).select("slot")
    maps = slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("map"))
    bits = bytearray((1 << FILTER_BITS) // 8 + MAP_BYTES)
    for r in maps.toLocalIterator():
        bits[r.bucket * MAP_BYTES:(r.bucket + 1) * MAP_BYTES] = r.map
    return bytes(bits)


def _is_in(bits: bytes, slot: Column) -> Column:
    # the library's buckets of 8 * MAP_BYTES slots start with 1: 0 is alone in bucket 0
    bucket = F.when(slot > 0, 1 + F.floor((slot - 1) / (8 * MAP_BYTES))).otherwise(F.lit(0))
    bit = F.when(slot > 0, (slot - 1) % (8 * MAP_BYTES)).otherwise(F.lit(0))
    byte = F.conv(F.hex(F.substr(F.lit(bits), (bucket * MAP_BYTES + F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def _groups(lines: DataFrame) -> DataFrame:
    """line, group, n, lead, text of the distinct lines ``lines`` (n, lead, line, text) after all splits."""
    shared = lines.groupBy("n", "lead").agg(F.count("*").alias("distinct")).where((F.col("distinct") > 1) & (F.col("n") > LEADING))
    placed = lines.join(shared.select("n", "lead"), ["n", "lead"]).withColumn("group", F.xxhash64("n", "lead"))
    for _ in range(LEVELS):
        placed = keep(placed.select("line", "group", "n", "lead", "text"), "leaves")
        tokens = placed.select("group", F.posexplode(F.split("text", " ")).alias("pos", "token")).where(F.col("pos") >= LEADING)
        have = tokens.groupBy("group", "pos", "token").agg(F.count("*").alias("have"))
        most = have.groupBy("group", "pos").agg(F.max("have").alias("most"), F.sum("have").alias("all"))
        # the position whose commonest token is commonest, the first of equals
        best = (
            most.where((F.col("most") < F.col("all")) & (F.col("most") >= 2) & (F.col("most") >= SHARE * F.col("all")))
            .groupBy("group").agg(F.min(F.struct((-F.col("most")).alias("less"), "pos")).alias("best"), F.max("all").alias("all"))
            .select("group", F.col("best.pos").alias("at"), "all")
        )
        own = have.join(best, "group").where((F.col("pos") == F.col("at")) & (F.col("have") >= 2) & (F.col("have") >= SHARE * F.col("all")))
        own = own.select("group", F.col("token").alias("__token"), F.lit(True).alias("__own"))
        placed = placed.join(best.drop("all"), "group", "left").withColumn("__at", F.get(F.split("text", " "), F.col("at")))
        placed = placed.join(own.withColumnRenamed("group", "__group"), (F.col("group") == F.col("__group")) & (F.col("__at") == F.col("__token")), "left")
        split = F.when(F.col("at").isNull(), F.col("group")).when(F.col("__own"), F.xxhash64("group", "at", "__at")).otherwise(F.xxhash64("group", "at"))
        placed = placed.select("line", split.alias("group"), "n", "lead", "text")
    return keep(placed, "leaves")


def _templates(lines: DataFrame) -> DataFrame:
    """line, template of the distinct lines whose group is a template."""
    placed = _groups(lines)
    tokens = placed.select("group", "n", F.posexplode(F.split("text", " ")).alias("pos", "token"))
    same = (
        tokens.groupBy("group", "pos").agg(F.min("token").alias("token"), F.max("token").alias("last"), F.count("*").alias("all"), F.first("n").alias("n"))
        .where((F.col("all") > 1) & (F.col("token") == F.col("last")))
    )
    general = (
        same.groupBy("group", "n").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("kept"))
        .where(F.size("kept") >= SIMILARITY * F.col("n"))
        .select("group", F.unhex(F.md5(F.to_json(F.struct("n", "kept")))).alias("template"))
    )
    return placed.select("line", "group").join(general, "group").select("line", "template")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, body, drop (positions from 1) of the documents (doc_id, text) that lose lines.
    ``body`` tells apart the texts of rows that repeat a doc_id."""
    bits = _crowded(docs)
    some = F.filter(_lines(), lambda x: _is_in(bits, x["slot"]))
    lines = docs.select("doc_id", F.xxhash64("text").alias("body"), F.explode(some).alias("x"))
    lines = keep(lines.select("doc_id", "body", "x.pos", "x.n", "x.lead", F.col("x.line").alias("text"), F.unhex(F.md5("x.line")).alias("line")), "lines")
    distinct = keep(lines.groupBy("n", "lead", "line").agg(F.first("text").alias("text")), "lines")
    general = keep(_templates(distinct), "templates")
    plain = lines.select("doc_id", "body", "pos", F.col("line").alias("template"), needed(F.col("n")).alias("needed"))
    grouped = lines.select("doc_id", "body", "pos", "line").join(general, "line").select("doc_id", "body", "pos", "template", F.lit(MIN_DOCS).alias("needed"))
    spots = keep(plain.unionByName(grouped), "spots")
    recurring = (
        spots.select("doc_id", "template", "needed").distinct()
        .groupBy("template", "needed").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first"))
        .where(F.col("docs") >= F.col("needed")).select("template", "first")
    )
    return (
        spots.join(recurring, "template").where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "body").agg(F.collect_set(F.col("pos") + 1).alias("drop"))
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` as it is after the drop, n_lines and n_dropped (both replaced
    where they exist)."""
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drops = dropped_lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    drops = keep(drops.select(F.col("doc_id").alias("__id"), F.col("body").alias("__body"), F.col("drop").alias("__drop")), "drops")
    lines = F.split(text, "\n")
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(1), F.col("n_lines")), F.col("__drop")), lambda i: F.element_at(F.col("__lines"), i)), "\n")
    joined = docs.select(*others).join(drops, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__body")), "left")
    return (
        joined.withColumn("n_lines", n).withColumn("__lines", lines)
        .withColumn("n_dropped", F.coalesce(F.size("__drop"), F.lit(0)))
        .withColumn(text, F.when(F.col("n_dropped") > 0, kept).otherwise(F.col(text)))
        .select(*others, "n_lines", "n_dropped")
    )


def _level(k: int) -> str:
    """SQL: the groups after one more split of those of level ``k``."""
    return f"""
), have{k} AS (
  SELECT grp, pos, token, count(*) AS have FROM (
    SELECT grp, unnest(string_split(line, ' ')) AS token, unnest(range(0, n)) AS pos FROM group{k}) WHERE pos >= {LEADING} GROUP BY ALL
), most{k} AS (
  SELECT grp, pos, max(have) AS most, sum(have) AS total FROM have{k} GROUP BY grp, pos
), best{k} AS (
  SELECT grp, pos AS at, total FROM most{k} WHERE most < total AND most >= 2 AND most >= {SHARE} * total
  QUALIFY row_number() OVER (PARTITION BY grp ORDER BY most DESC, pos) = 1
), own{k} AS (
  SELECT h.grp, h.token FROM have{k} h JOIN best{k} b ON h.grp = b.grp AND h.pos = b.at WHERE have >= 2 AND have >= {SHARE} * total
), group{k + 1} AS (
  SELECT line, n, CASE WHEN b.at IS NULL THEN g.grp
                       WHEN o.token IS NOT NULL THEN g.grp || chr(10) || b.at || '=' || o.token ELSE g.grp || chr(10) || b.at END AS grp
  FROM group{k} g LEFT JOIN best{k} b ON g.grp = b.grp
  LEFT JOIN own{k} o ON g.grp = o.grp AND string_split(line, ' ')[b.at + 1] = o.token"""


ORACLE = rf"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos
  FROM documents WHERE text IS NOT NULL
), masked AS (
  SELECT doc_id, text, pos,
         regexp_replace(trim(regexp_replace(line, '[ \t\r\f\x0B]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line
  FROM split
), lines AS (
  SELECT *, len(string_split(line, ' ')) AS n, array_to_string(string_split(line, ' ')[1:{LEADING}], ' ') AS lead
  FROM masked WHERE line <> ''
), group0 AS (
  SELECT DISTINCT line, n, n || ' ' || lead AS grp FROM lines WHERE n > {LEADING}
  QUALIFY count(*) OVER (PARTITION BY n, lead) > 1{"".join(_level(k) for k in range(LEVELS))}
), same AS (
  SELECT grp, n, pos, min(token) AS token FROM (
    SELECT grp, n, unnest(string_split(line, ' ')) AS token, unnest(range(0, n)) AS pos FROM group{LEVELS})
  GROUP BY grp, n, pos HAVING count(*) > 1 AND count(DISTINCT token) = 1
), general AS (
  SELECT grp, 'g' || n || ' ' || list({{'pos': pos, 'token': token}} ORDER BY pos)::VARCHAR AS template
  FROM same GROUP BY grp, n HAVING count(*) >= {SIMILARITY} * n
), spots AS (
  SELECT doc_id, pos, 'l' || line AS template, CASE WHEN n >= {LONG} THEN 2 ELSE {MIN_DOCS} END AS needed FROM lines
  UNION ALL
  SELECT doc_id, pos, template, {MIN_DOCS} FROM lines JOIN group{LEVELS} USING (line, n) JOIN general USING (grp)
), recurring AS (
  SELECT template, min(doc_id) AS first FROM spots GROUP BY template, needed HAVING count(DISTINCT doc_id) >= needed
), drops AS (
  SELECT DISTINCT doc_id, pos FROM spots JOIN recurring USING (template) WHERE doc_id <> first
), marked AS (
  SELECT s.doc_id, s.line, s.pos, d.pos IS NOT NULL AS dropped
  FROM split s LEFT JOIN drops d USING (doc_id, pos)
), rebuilt AS (
  SELECT doc_id, count(*) AS n_lines, count_if(dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_dropped, 0) AS INTEGER) AS n_dropped, r.text
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
"""
