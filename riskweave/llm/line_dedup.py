"""Lines that several documents share are dropped from all but one of them. DataFrame functions only.

Lines are exploded with their places, normalised to keys (ASCII blanks stripped at both ends, A-Z
as a-z) and hashed to 128 bits, and distinct documents are counted per hash. A key of
``min_chars`` code points or more that ``min_docs`` documents hold loses its lines everywhere but
in the document with the smallest id that holds it. What stays is put together by place.

Counting combines within tasks, first by (key, document) and then by key, so that a line that a
third of all documents share is a few rows. Keys with over a ``HEAVY``-th of all keyed lines, at
most ``HEAVY`` of them, are a broadcast table; all others, none of which can be a large group, are
joined by a shuffle. Texts are shuffled once, to meet the places they lose.

Defined cases: a null text is empty, and an empty text is one empty line; a text with a line end
at its end has an empty last line; rows that repeat a doc_id are one document when
documents are counted, and each keeps its own result; rows without doc_id are no document:
they count for nothing and keep all lines; an empty table gives an empty one. Texts are handled
whole; a place is four bytes. Further columns are carried along; one named like a new column
gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import stored

#: Keys of at least so many code points, held by at least so many documents, are dropped.
MIN_CHARS = 10
MIN_DOCS = 2
#: Keys in the broadcast table at most: those with more than this part of all keyed lines.
HEAVY = 1_000

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NEW = ("kept_text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at its ends, A-Z as a-z."""
    bare = F.trim(line, F.lit(_BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    # lower() is the fast way, but it changes more than A-Z where there is more than ASCII.
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _digest() -> Column:
    """Tells rows that repeat a doc_id apart, unless their texts are equal."""
    return F.xxhash64("text").alias("digest")


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, digest, pos, h1, h2) of the lines whose keys are long enough."""
    lines = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", _digest(), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    # A line has no more code points than bytes, so most short ones go before any work.
    long = lines.filter(F.octet_length("line") >= min_chars)
    keys = long.select("doc_id", "digest", "pos", line_key(F.col("line")).alias("key"))
    return keys.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "digest", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Two tables (h1, h2, first): heavy keys (first is null if they stay), and the others that go."""
    cut = lines.count() // HEAVY + 1
    keys = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first")
    )
    keys = keys.withColumn("first", F.when(F.col("docs") >= min_docs, F.col("first")))
    keys = stored(keys.filter(F.col("first").isNotNull() | (F.col("lines") >= cut)), "repeated-keys")
    heavy = keys.filter(F.col("lines") >= cut).select("h1", "h2", "first", F.lit(True).alias("heavy"))
    return heavy, keys.filter(F.col("lines") < cut).select("h1", "h2", "first")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, digest, places): the sorted places of the lines that each text loses, if any."""
    lines = stored(keyed_lines(docs, min_chars), "lines")
    heavy, light = repeated_keys(lines, min_docs)
    place = ["doc_id", "digest", "pos"]
    marked = lines.join(F.broadcast(heavy), ["h1", "h2"], "left")
    gone = marked.filter("heavy and doc_id > first").select(place)
    rest = marked.filter("heavy is null").select(*place, "h1", "h2").join(light, ["h1", "h2"])
    gone = gone.union(rest.filter("doc_id > first").select(place))
    # Equal rows name a place twice.
    return gone.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("pos")).alias("places"))


def _kept(text: Column, places: Column) -> Column:
    """The runs of lines between dropped places, joined; linear in the lines."""

    def runs(x):
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(x["places"], i - 1) + 1)
        return F.transform(
            F.sequence(F.lit(0), F.size(x["places"])),
            lambda i: F.slice(
                x["lines"], before(i) + 1, F.coalesce(F.get(x["places"], i), F.size(x["lines"])) - before(i)
            ),
        )

    # Bound to a name, the text is split once and not for each run.
    bound = F.array(F.struct(F.split(text, "\n").alias("lines"), places.alias("places")))
    return F.array_join(F.flatten(F.get(F.transform(bound, runs), F.lit(0))), "\n")


def drop_repeated(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with kept_text, n_lines (before dropping) and n_dropped."""
    carried = [c for c in docs.columns if c.lower() not in _NEW]
    lost = dropped_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), "doc_id", "text", _digest())
    # Rows without id lose nothing and need not meet anything.
    met = rows.filter("doc_id is not null").join(lost, ["doc_id", "digest"], "left").select("row", "text", "places")
    whole = rows.filter("doc_id is null").select("row", "text", F.lit(None).cast("array<int>").alias("places"))
    text, places = F.coalesce("text", F.lit("")), F.col("places")
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return met.union(whole).select(
        *[F.col(f"row.`{c}`").alias(c) for c in carried],
        F.when(places.isNull(), text).otherwise(_kept(text, places)).alias("kept_text"),
        (ends + 1).cast("long").alias("n_lines"),
        F.when(places.isNull(), F.lit(0)).otherwise(F.size(places)).cast("long").alias("n_dropped"),
    )


ORACLE = f"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key
    from lines
), shared as (
    select key, min(doc_id) as first from keyed
    where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) >= {MIN_DOCS}
), marked as (
    select k.*, coalesce(k.doc_id > s.first, false) as gone from keyed k left join shared s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
