"""Lines that many documents share are dropped from all but one of them.

Lines are exploded with their positions, normalised and hashed; distinct documents are counted for
each hash, those over the threshold are joined back to the lines, and each text is put together
again from the positions that stay. A hash is 128 bits (two 64-bit ones), so that different lines
don't meet even among 10^12.

No key gathers its rows in one task: documents are counted by (hash, document) first and by hash
from partial counts; hashes that hold more than 1 / ``FEW`` of all dropped lines are at most ``FEW``,
are broadcast, and their lines are dealt over salted copies of the key.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets, by_position, columns_of, written

#: Fixed value: what is stripped from both ends of a line.
SPACE = " \t\n\x0b\x0c\r"
#: Hot hashes that are broadcast, at most.
FEW = 4096

_KEY = ["_k1", "_k2"]
_ROW = ["_id", "_t1", "_t2"]


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    plain = F.octet_length(bare) == F.length(bare)  # ASCII only: the quick way is the same
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(value, names: list[str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """_id, hashes of the text, position and hashes of the key, for lines whose key is long enough."""
    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = rows.select("_id", *_hashes("_text", _ROW[1:]), F.posexplode(_split(F.col("_text"))).alias("_pos", "_line"))
    keyed = rows.select(*_ROW, "_pos", line_key(F.col("_line")).alias("_line")).where(F.length("_line") >= least_chars)
    return keyed.select(*_ROW, "_pos", *_hashes("_line", _KEY))


def frequent(lines: DataFrame, least_docs: int) -> DataFrame:
    """Hashes that at least so many documents hold, with the largest id of these; stored."""
    held = lines.groupBy(*_KEY, "_id").agg(F.lit(1).alias("_one"))
    counted = held.groupBy(*_KEY).agg(F.count("*").alias("_n"), F.max("_id").alias("_last"))
    return written(counted.where(F.col("_n") >= least_docs), "frequent")


def dropped(lines: DataFrame, often: DataFrame) -> DataFrame:
    """For each row with lines to drop, their positions."""
    spark = lines.sparkSession
    total = often.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    salts = buckets(spark)
    hot = often.where(F.col("_n") > F.lit(total) / FEW).select(*_KEY, F.lit(True).alias("_hot"))
    lines = lines.join(F.broadcast(hot), _KEY, "left")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_id", "_t1"), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    copies = F.when(F.col("_n") > F.lit(total) / FEW, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    often = often.select(*_KEY, "_last", F.explode(copies).alias("_salt"))
    met = lines.withColumn("_salt", salt).join(often, [*_KEY, "_salt"])
    gone = met.where(~F.col("_id").eqNullSafe(F.col("_last")))
    return gone.groupBy(*_ROW).agg(F.collect_set("_pos").alias("_gone"))


def drop_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """The documents without lines that at least ``least_docs`` documents share.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case; keys of
    fewer than ``least_chars`` code points stay. A key found often enough loses its lines in all
    documents but the one with the largest doc_id that holds it. ``text`` is what stays, joined by
    line feeds; ``n_lines`` counts the lines before, ``n_dropped`` those that went.

    A null or empty text is one empty line and becomes an empty text. Rows that repeat are one
    document, as are all rows with one doc_id, and each is returned; those without a doc_id are
    one document below all others. A text of any length is split within one task. Other columns
    stay, but n_lines and n_dropped take the place of columns with their names. An empty table
    gives no row.
    """
    lines = long_lines(docs, least_chars)
    gone = dropped(lines, frequent(lines, least_docs)).toDF("_gid", "_g1", "_g2", "_gone")
    plain, (doc_id, text) = by_position(docs, "doc_id", "text")
    text = text.cast("string")
    have = {f"c{i}": name for i, name in enumerate(docs.columns) if name not in ("text", "n_lines", "n_dropped")}
    other = F.struct(F.lit(0).alias("none"), *have)
    rows = plain.select(doc_id.alias("_id"), *_hashes(text, _ROW[1:]), F.coalesce(text, F.lit("")).alias("_text"), other.alias("_other"))
    same = rows._id.eqNullSafe(gone._gid) & (rows._t1 == gone._g1) & (rows._t2 == gone._g2)
    both = rows.join(gone, same, "left").withColumn("_lines", _split(F.col("_text")))
    n = F.size("_lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_gone"))  # by position, in order
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda k: F.get("_lines", k)), "\n"))
    out = both.select(*[F.col(f"_other.{c}") for c in have], kept, n.cast("long"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
    return out.toDF(*have.values(), "text", "n_lines", "n_dropped")


def oracle(least_chars: int = 40, least_docs: int = 5) -> str:
    """The contract's columns in DuckDB SQL."""
    ends = " || ".join(f"chr({ord(c)})" for c in SPACE)
    return f"""
WITH l AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, translate(trim(line, {ends}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
o AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {least_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {least_docs}),
d AS (SELECT k.*, coalesce(doc_id <> last, false) AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id"""
