"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised benchmark texts.

A-Z are lower-cased and every other ASCII character but letters and digits parts words. Words become
numbers of the benchmark's vocabulary (0: not in it); the automaton walks a text's numbers once and
keeps every word that some window covers, and where that word stood in the original text.

Defined results: a null or empty text has no words; benchmark items without words have no window, items
of equal item_id are one item, and an item with a null id covers words but is neither counted nor named;
an empty benchmark leaves every document clean; repeated documents are judged each on its own; a text of
any length is walked in stretches of bounded bytes, the automaton's state going from one to the next;
other columns of docs stay out unless named in carry, and give way to result columns of the same name.
"""
import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cols, materialise, text_udf
from .divergence import pieces

#: A-Z to a-z, all other ASCII but a-z and 0-9 to a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
RESULT = "n_words long, n_hit long, items array<string>, runs array<struct<first:long,last:long>>, spans array<struct<start:long,end:long>>"
_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_BUILT: dict = {}


def automaton(items, window: int):
    """items (id, text bytes) -> (vocabulary, automaton whose values are (length, numbers of items), ids), or None without a window."""
    import ahocorasick

    vocabulary, windows, ids = {}, {}, sorted({i for i, _ in items if i is not None})
    number = {x: k for k, x in enumerate(ids)}
    for i, text in items:
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in (text or b"").translate(WORDS).split()]
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + window]), set()).update(() if i is None else (number[i],))
    if not windows:
        return None
    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for w, held in windows.items():
        a.add_word(w, (len(w), tuple(held)))
    a.make_automaton()
    return vocabulary, a, ids


def walk(text: bytes, built):
    """Words of a text, the runs (first, last) of those that windows cover, and the ids of items found."""
    vocabulary, a, ids = built
    known, found, at, it, covered = vocabulary.get, set(), 0, None, bytearray()
    for part in pieces(text.translate(WORDS)):
        words = tuple([known(w, 0) for w in part.split()])
        covered.extend(bytes(len(words)))
        if words:
            it = a.iter(words) if it is None else it
            if at:
                it.set(words)
            for end, (length, held) in it:
                covered[end - length + 1 : end + 1] = b"\1" * length
                found.update(held)
        at += len(words)
    return at, _runs(covered), [ids[k] for k in found]


def _runs(covered):
    """(first, last) of each stretch of ones."""
    out, at = [], covered.find(1)
    while at >= 0:
        end = covered.find(0, at)
        end = len(covered) if end < 0 else end
        out.append((at, end - 1))
        at = covered.find(1, end)
    return out


def _joined(a, b):
    """Runs of two sorted lists as one list of runs that neither touch nor overlap."""
    out = []
    for first, last in sorted([*a, *b]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def places(text: bytes, runs):
    """Runs of words as (start, end) in code points of the original text, end exclusive."""
    import numpy as np

    raw = np.frombuffer(text, np.uint8)
    inside = np.frombuffer(text.translate(WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b]])) for a, b in runs]


def _scan(items, window):
    """An Arrow UDF text -> RESULT, joined to the runs and items found so far."""

    key = uuid.uuid4().hex

    def run(texts, runs, named):
        if key not in _BUILT:  # once a worker
            _BUILT.clear()
            _BUILT[key] = automaton(items.value, window)
        built, out = _BUILT[key], []
        for t, was, had in zip(texts, runs.to_pylist(), named.to_pylist()):
            n, now, found = walk(t, built) if built else (len(t.translate(WORDS).split()), [], [])
            now = _joined(now, [(r["first"], r["last"]) for r in was or ()])
            out.append((n, sum(b - a + 1 for a, b in now), sorted({*found, *(had or ())}), now, places(t, now) if now else []))
        n, hit, names, now, spans = zip(*out) if out else ((),) * 5
        return pa.StructArray.from_arrays([
            pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(names, pa.list_(pa.string())),
            pa.array([[{"first": a, "last": b} for a, b in r] for r in now], _RUNS), pa.array([[{"start": a, "end": b} for a, b in r] for r in spans], _SPANS)],
            ["n_words", "n_hit", "items", "runs", "spans"])

    return text_udf(run, f"struct<{RESULT.replace(' ', ':').replace(',:', ',')}>", "runs", "items")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, part_bytes: int = 2 << 20, carry=()) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) -> doc_id (or carry), n_words, n_hit, items, spans, contaminated.

    items: sorted ids of items a window of which occurs; spans: the covered words' places in the text.
    The benchmark's size is measured: up to part_bytes of text make one automaton, which is broadcast (some
    ten nodes a word); a larger one is taken in parts by a hash of its text, and what the walks have found is
    stored between them, so that no worker holds more than one part.
    """
    b = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(1.25 * size / part_bytes)) if size > part_bytes else 1
    spark, own = docs.sparkSession, ("n_words", "n_hit", "items", "spans", "contaminated")
    kept = [c for c in (carry or ["doc_id"]) if c not in own]
    none = F.array().cast("array<struct<first:long,last:long>>"), F.array().cast("array<string>")
    x = docs.select(F.struct(*cols(docs, kept)).alias("row"), F.col("text").cast("string").alias("text"))
    for k in range(parts):
        some = b.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == k) if parts > 1 else b
        items = spark.sparkContext.broadcast([(r.item_id, (r.text or "").encode()) for r in some.collect()])
        found = F.col("found.runs"), F.col("found.items")
        x = x.select("row", "text", _scan(items, window)("text", *(found if k else none)).alias("found"))
        if k + 1 < parts:
            x = materialise(x)
    out = [F.col(f"found.{c}").alias(c) for c in own[:4]]
    return x.select("row.*", *out, (F.col("found.n_hit") > 0).alias("contaminated"))


def _words(text):
    return rf"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents), b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS k FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS k FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT l FROM bw))),
h AS (SELECT r, i, l, item_id FROM dw JOIN bw USING (l, k)),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS k FROM (SELECT DISTINCT r, i, l FROM h)) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)"""
