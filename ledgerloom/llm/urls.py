"""URL filters: rules in a sorted array of digests, memory-mapped and probed in batches."""

from __future__ import annotations

import hashlib
import mmap
import os
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import lower_ascii, ship_package
from ledgerloom.operators.joins import lookup

# Bytes of an index that is sent to every executor; larger rule sets are joined by digest instead.
MAX_INDEX_BYTES = 256 * 1024 * 1024
DEFAULT = "allow"

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Covers ``host``, all its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def can_fit(self) -> bool:
        """No URL has these marks in its host, and a path is empty or starts with a slash."""
        return not set("/?#") & set(self.host) and (not self.path or self.path[0] == "/")


def _digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


class RuleIndex:
    """Digests in order, and beside them verdicts and whole texts of the rules, in one buffer.

    Layout, all little-endian 64-bit numbers before the texts: rules, path lengths, the lengths
    that occur, digests, ends of the texts, verdicts; then the texts.
    """

    def __init__(self, buffer):
        n, n_lengths = (int(x) for x in np.frombuffer(buffer, "<u8", 2))
        numbers = np.frombuffer(buffer, "<u8", n_lengths + 3 * n, 16)
        self.lengths = numbers[:n_lengths].astype(int).tolist()
        self.digests, self.ends, self.verdicts = np.split(numbers[n_lengths:], 3)
        self._texts = memoryview(buffer)[16 + 8 * len(numbers) :]

    @staticmethod
    def build(rules: Iterable[Rule], verdicts: list[str]) -> bytes:
        """Of rules with the same text the last one counts."""
        last = {r.text.encode(): r for r in rules if r.can_fit}
        texts = sorted(last, key=lambda t: (_digest(t), t))
        lengths = sorted({len(last[t].path) for t in texts})
        numbers = [len(texts), len(lengths), *lengths, *map(_digest, texts)]
        numbers += np.cumsum([len(t) for t in texts], dtype=np.int64).tolist()
        numbers += [verdicts.index(last[t].verdict) for t in texts]
        return np.array(numbers, "<u8").tobytes() + b"".join(texts)

    def text(self, place: int) -> bytes:
        start = int(self.ends[place - 1]) if place else 0
        return bytes(self._texts[start : int(self.ends[place])])

    def best(self, hosts: list[str], paths: list[str]) -> list[int]:
        """Per URL the place of the longest rule that covers it, -1 if none does.

        Lengths are in code points; of two as long, that with the longer host counts. Probed are all parent domains with all starts of the path as long as that of some rule.
        """
        rows, keys, sizes = [], [], []
        for row, (host, path) in enumerate(zip(hosts, paths)):
            starts = [path[:n] for n in self.lengths if n <= len(path)]
            labels = host.split(".")
            for i in range(len(labels)):
                parent = ".".join(labels[i:])
                keys += [(parent + start).encode() for start in starts]
                sizes += [(len(parent) + len(start), len(parent)) for start in starts]
            rows += [row] * (len(keys) - len(rows))
        result = [-1] * len(hosts)
        if not keys or not len(self.digests):
            return result
        probes = np.fromiter(map(_digest, keys), np.uint64, len(keys))
        places = np.searchsorted(self.digests, probes)
        inside = np.minimum(places, len(self.digests) - 1)
        longest = [(-1, -1)] * len(hosts)
        for k in np.flatnonzero(self.digests[inside] == probes).tolist():
            place, row = int(places[k]), rows[k]
            # Rules of one digest stand together; the whole text decides.
            while place < len(self.digests) and self.digests[place] == probes[k]:
                if self.text(place) == keys[k] and sizes[k] > longest[row]:
                    result[row], longest[row] = place, sizes[k]
                place += 1
        return result


def _shipped(spark: SparkSession, content: bytes) -> str:
    """The name of a file with the content that Spark copies to every executor, once."""
    name = f"rules-{hashlib.sha256(content).hexdigest()}.idx"
    if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
        path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), name)
        with open(path, "wb") as file:
            file.write(content)
        spark.sparkContext.addFile(path)
    return name


def _mapped(name: str) -> RuleIndex:
    """The index mapped from its file, whose pages the Python workers of an executor share."""
    with open(SparkFiles.get(name), "rb") as file:
        return RuleIndex(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def _by_index(parsed: DataFrame, content: bytes, verdicts: list[str]) -> DataFrame:
    ship_package(parsed.sparkSession)
    name = _shipped(parsed.sparkSession, content)

    @F.pandas_udf("rule string, verdict string")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = _mapped(name)
        for hosts, paths in batches:
            best = index.best(hosts.tolist(), paths.tolist())
            yield pd.DataFrame({
                "rule": [index.text(b).decode() if b >= 0 else None for b in best],
                "verdict": [verdicts[int(index.verdicts[b])] if b >= 0 else DEFAULT for b in best],
            }, dtype=object)

    return parsed.select("*", probe("host", "path").alias("_r")).select(*parsed.columns, "_r.*")


def _by_join(parsed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same without sending rules to executors: candidate texts meet rules in a join.

    Of rules with the same text, that with the largest ``number`` counts.
    """
    fits = ~F.rlike("host", F.lit("[/?#]")) & ((F.col("path") == "") | F.startswith("path", F.lit("/")))
    rules = rules.where(fits).groupBy(F.concat("host", "path").alias("rule")).agg(
        F.max_by(F.struct("host", "path", "verdict"), "number").alias("_last")
    ).select("rule", "_last.*")
    lengths = sorted(r[0] for r in rules.select(F.char_length("path")).distinct().collect())
    labels = F.split("host", r"\.")
    starts = F.filter(
        F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.left(F.col("path"), n)),
        lambda s: F.array_contains(F.array(*[F.lit(n) for n in lengths]), F.char_length(s)),
    )
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    keys = F.array_distinct(
        F.flatten(F.transform(parents, lambda p: F.transform(starts, lambda s: F.concat(p, s))))
    )
    pairs = parsed.select("host", "path").distinct()
    known = rules.select("rule", "verdict", F.char_length("host").alias("_host"))
    met = lookup(pairs.select("host", "path", F.explode(keys).alias("rule")), known, ["rule"], "inner")
    best = met.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.char_length("rule"), "_host")).alias("_r")
    )
    found = lookup(parsed, best, ["host", "path"])
    return found.select(
        *parsed.columns, F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", F.lit(DEFAULT)).alias("verdict")
    )


def judge(
    pages: DataFrame,
    rules: list[Rule] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    max_index_bytes: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """The verdict on each URL: that of the longest rule that covers it, else ``allow``.

    ``rules`` are a list, or a table with ``number`` (unique), ``host``, ``path`` and ``verdict``; of rules with the same
    text the last one, or that with the largest number, counts. The longest rule has the most code
    points, and of two as long the longer host.

    The rules are an array of sorted 64-bit digests with verdicts and texts beside them. Every
    worker maps it from a local file, probes the digests of all parents and path starts of a
    batch of URLs by binary search, and compares whole texts where a digest is found. An index of
    more than ``max_index_bytes`` is not sent around; candidates and rules are joined instead.

    Returns id, ``host``, ``path``, ``rule`` and ``verdict``, a row per row. A null URL or one
    without ``://`` has an empty host and path, which no rule with a host covers. An empty list of
    rules allows everything.
    """
    parsed = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    if isinstance(rules, list):
        listed = parsed.sparkSession.createDataFrame(
            [(i, r.host, r.path, r.verdict) for i, r in enumerate(rules)], "number bigint, host string, path string, verdict string"
        )
        size = sum(24 + len(r.text.encode()) for r in rules)
    else:
        listed = rules.select("number", "host", "path", "verdict")
        bytes_of = F.octet_length(F.concat("host", "path")) + 24
        size = listed.agg(F.sum(bytes_of)).first()[0] or 0
    if size > max_index_bytes:
        return _by_join(parsed, listed)
    if not isinstance(rules, list):
        rules = [Rule(r.host, r.path, r.verdict) for r in listed.orderBy("number").collect()]
    verdicts = sorted({r.verdict for r in rules})
    return _by_index(parsed, RuleIndex.build(rules, verdicts), verdicts)


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]

ORACLE = r"""
WITH p AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) v(h, p, verdict)),
m AS (
    SELECT page_id, h || r.p AS rule, verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(h || r.p) DESC) AS nth
    FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND nth = 1
"""
