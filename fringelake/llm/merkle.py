"""Document fingerprints as Merkle trees: root, sections, paragraphs, leaves.

A section is what blank lines part, a paragraph is a line, a leaf is up to ``PIECE`` characters of a sentence with the
". " behind it. A leaf's hash is the MD5 of its text; a branch's is the MD5 of its children's, one after another. Every
separator is implied by the tree's shape, so equal roots mean equal texts. The fingerprint is the root in hexadecimal
and, by level, 64 bits of each hash in base 64: ``root/section:paragraph.leaf leaf,paragraph.leaf;section:...`` without
the blanks. From two fingerprints alone: equality (roots), where they differ (branches whose hashes differ, then
leaves), and how much they share (leaves).

The next document in descending order of ids is found without a global window: rows are dealt into ranges of (id, hash
of the text), a range to a task, and the head of each range is also sent to the range before it. An id that many rows
have, or none, is cut into ranges by the hash.

Defined cases: null counts as empty; a null id comes last; rows with the same id follow one another by a hash of the
text; rows equal in both follow one another; a lone document is its own successor; very long texts are one row like
others; an empty table gives no rows; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from base64 import b64encode
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

PIECE = 48
CODE = 11  # base-64 digits of 64 bits
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def pieces(paragraph: str) -> list[str]:
    """The leaves' texts; joined, they are the paragraph."""
    out = []
    sentences = paragraph.split(". ")
    for k, s in enumerate(sentences):
        if k < len(sentences) - 1:
            s += ". "
        out += [s] if len(s) <= PIECE else [s[i : i + PIECE] for i in range(0, len(s), PIECE)]
    return out


def _code(digest: bytes) -> str:
    return b64encode(digest[:8])[:CODE].decode()


def fingerprint(text: str) -> str:
    md5 = hashlib.md5
    tops, shown = [], []
    for section in text.split("\n\n"):
        nodes, lines = [], []
        for paragraph in section.split("\n"):
            hashes = [md5(x.encode(), usedforsecurity=False) for x in pieces(paragraph)]
            node = md5("".join([h.hexdigest() for h in hashes]).encode(), usedforsecurity=False)
            nodes.append(node.hexdigest())
            lines.append(_code(node.digest()) + "." + "".join([_code(h.digest()) for h in hashes]))
        top = md5("".join(nodes).encode(), usedforsecurity=False)
        tops.append(top.hexdigest())
        shown.append(_code(top.digest()) + ":" + ",".join(lines))
    return md5("".join(tops).encode(), usedforsecurity=False).hexdigest() + "/" + ";".join(shown)


def tree(print_: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    """The sections of a fingerprint: (hash, paragraphs), each paragraph (hash, leaves)."""
    out = []
    for section in print_.partition("/")[2].split(";"):
        top, _, rest = section.partition(":")
        lines = [(line[:CODE], [line[i : i + CODE] for i in range(CODE + 1, len(line), CODE)]) for line in rest.split(",")]
        out.append((top, lines))
    return out


def leaves(print_: str) -> Counter:
    found: Counter = Counter()
    for section in print_.partition("/")[2].split(";"):
        for line in section[CODE + 1 :].split(","):
            found.update(line[i : i + CODE] for i in range(CODE + 1, len(line), CODE))
    return found


def likeness(a: str, b: str) -> float:
    """Shared leaves of two fingerprints, twice, over all their leaves: 1 for equal texts, 0 if nothing is shared."""
    return 1.0 if a[:32] == b[:32] else _share(leaves(a), leaves(b))


def _share(x: Counter, y: Counter) -> float:
    if len(y) < len(x):
        x, y = y, x
    common = sum(min(n, y[k]) for k, n in x.items() if k in y)
    return 2.0 * common / (x.total() + y.total())


def edits(a: str, b: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, leaf) of ``b`` that have no equal at the same place in ``a``; equal branches are not entered."""
    if a[:32] == b[:32]:
        return []
    x, out = tree(a), []
    for i, (top, lines) in enumerate(tree(b)):
        old = x[i] if i < len(x) else ("", [])
        if old[0] == top:
            continue
        for j, (node, own) in enumerate(lines):
            was = old[1][j] if j < len(old[1]) else ("", [])
            if was[0] != node:
                out += [(i, j, k) for k, leaf in enumerate(own) if k >= len(was[1]) or was[1][k] != leaf]
    return out


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, text, next text) for rows sorted by part, head copies last, ids descending."""
    part = held = None
    done = False
    for batch in batches:
        for p, copy, i, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            text = text or ""
            if p != part:
                part, held, done = p, None, False
            if held is not None and not done:
                yield *held, text
            held, done = (i, text), bool(copy)


def ranges(rows: DataFrame, n: int) -> list[tuple[int, int]]:
    """At most n - 1 bounds of (k, h), descending: quantiles of k, and within a k that holds several of them, steps of h."""
    found = rows.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    out = []
    for k, times in Counter(found).items():
        out += [(k, _HIGH if times == 1 else _LOW + ((1 << 64) - 1) * i // times) for i in range(1, times + 1)]
    return sorted(out, reverse=True)


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document, with its successor in descending order: fingerprints of its text and its edited text, and likenesses."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(doc).cast("long"), F.lit(_LOW)).alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ranges(rows, n)
    own = F.struct("k", "h")
    # bounds in groups of about the root of their number: a row is compared with the groups' firsts, then with one group
    per = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + per] for i in range(0, len(cuts), per)]

    def literal(some: list[tuple[int, int]]):
        return F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(h).cast("long").alias("h")) for k, h in some])

    part = F.lit(0)
    if cuts:
        group = F.size(F.filter(literal([g[0] for g in groups]), lambda c: c >= own)) - 1
        part = F.when(group >= 0, group * per + F.size(F.filter(F.get(F.array(*[literal(g) for g in groups]), group), lambda c: c >= own))).otherwise(0)
    rows = rows.withColumn("part", part.cast("int"))
    heads = sorted(tuple(r) for r in rows.groupBy("part").agg(F.max(own).alias("one")).select("part", "one.k", "one.h").collect())  # one row per part
    before = [(heads[j - 1][0], k, h) for j, (_, k, h) in enumerate(heads)]
    dealt = rows.withColumn("copy", F.lit(0))
    if before:
        at = spark.createDataFrame(before, "part int, k long, h long")
        dealt = dealt.unionByName(rows.drop("part").join(F.broadcast(at), ["k", "h"]).withColumn("copy", F.lit(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        out: list[tuple] = []
        size = 0
        last = ("", "", Counter())
        for i, text, following in _followed(batches):
            own, own_leaves = last[1:] if last[0] == text and last[1] else (p := fingerprint(text), leaves(p))
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            changed = own if edited == text else fingerprint(edited)
            then = own if following == text else fingerprint(following)
            last = (following, then, own_leaves if then is own else leaves(then))
            near = 1.0 if changed[:32] == own[:32] else _share(own_leaves, leaves(changed))
            after = 1.0 if then[:32] == own[:32] else _share(own_leaves, last[2])
            out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, near, after))
            size += len(own) + len(changed)
            if size > 4 << 20:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out, size = [], 0
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    dealt = dealt.select("part", "copy", "doc_id", "text", "k", "h").repartitionById(n, F.col("part")).sortWithinPartitions("part", "copy", F.desc("k"), F.desc("h"), "text")
    return dealt.mapInArrow(run, SCHEMA)
