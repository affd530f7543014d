"""Repeated lines across documents: explode, hash, count documents, drop, reassemble."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, doc_id, documents, join_sized, marked, saved


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, mark, pos, hash) of the lines whose normalised form has at least ``min_chars`` code points."""
    lines = marked(docs).select("id", "mark", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    bare = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter(F.length("line") >= min_chars)
    return bare.select("id", "mark", "pos",
                       F.unhex(F.md5(F.translate("line", UPPER, LOWER))).alias("hash"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): documents without the lines that many documents share.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least ``min_chars``
    code points that at least ``min_docs`` documents hold lose their lines everywhere but in the largest of these
    doc_ids. A null or empty text is one empty line. Rows with one doc_id count as one document; a null doc_id
    counts as one document and as the largest. An empty table gives an empty result; other columns are ignored.

    Only hashes travel in the count; per (key, document) sums come first, so a line that a third of all
    documents hold reaches its reducer as one row a task. Keys with many lines are broadcast in the join back.
    A text is put together again in one pass over its lines.
    """
    lines = saved(line_keys(docs, min_chars), "line-keys")
    per_doc = lines.groupBy("hash", "id").agg(F.count("*").alias("n"))
    heavy = saved(per_doc.groupBy("hash").agg(F.count("*").alias("docs"), F.sum("n").alias("lines"),
                                              F.max("id").alias("last"))
                  .filter(F.col("docs") >= min_docs).select("hash", "last", "lines"), "line-heavy")
    dropped = (join_sized(lines, heavy, ["hash"], "lines", lines.count()).filter("id < last")
               .groupBy("id", "mark").agg(F.collect_set("pos").alias("gone")))

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept = [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                parts, out = text.split("\n"), set(gone or ())
                sizes.append((len(parts), len(out)))
                kept.append("\n".join(x for k, x in enumerate(parts) if k not in out) if out else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([x[k] for x in sizes], pa.int64()) for k in (0, 1)), pa.array(kept, pa.string())],
                ["id", "n_lines", "n_dropped", "kept"])

    joined = marked(docs).join(dropped, ["id", "mark"], "left").select("id", "text", "gone")
    return joined.mapInArrow(reassemble, "id bigint, n_lines bigint, n_dropped bigint, kept string").select(
        doc_id(), "n_lines", "n_dropped", "kept")


SQL = r"""with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos from documents),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
heavy as (
  select key, max(doc_id) last_id from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, h.key is not null and doc_id < h.last_id gone from k left join heavy h using (key))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id"""


def query(spark, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
