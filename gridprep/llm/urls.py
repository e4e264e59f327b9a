"""URL filters by a sorted digest array: 64-bit xxhash keys, memory-mapped and probed by vectorised binary search.

A rule names a host and a beginning of the path. It fits its host and all subdomains, if the path starts with the
rule's; of several that fit the longest wins. For a url the candidates are its host's suffixes joined with the path's
beginnings of the lengths that occur among the rules; a found key counts only if the stored full string is the
candidate itself.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules in one file; a longer list makes several, which are probed in turn. A file is some hundred MB at most, mapped and
#: not read whole.
FILE_RULES = 5_000_000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://` or for a null."""
    pattern = r"://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(url, pattern, 1), upper, lower)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


class DigestArray:
    """Sorted keys with their strings and values, in one file that readers map into memory."""

    @staticmethod
    def write(path: str, rules: list[tuple[str, str, str]]) -> None:
        """rules: host, path, verdict. Of equal (host, path) a block wins over an allow."""
        best: dict[tuple[str, str], str] = {}
        for host, start, verdict in rules:
            if best.get((host, start)) != "block":
                best[host, start] = verdict
        rows = sorted((xxhash.xxh64_intdigest(f"{h}{p}".encode()), f"{h}{p}".encode(), len(h.encode()), v == "block") for (h, p), v in best.items())
        keys = np.array([r[0] for r in rows], "<u8")
        ends = np.cumsum([0, *(len(r[1]) for r in rows)]).astype("<u8")
        hosts = np.array([r[2] for r in rows], "<u4")
        blocks = np.array([r[3] for r in rows], "<u4")
        lengths = np.array(sorted({len(p.encode()) for _, p in best}), "<u4")
        # only a host's suffixes of up to so many bytes and labels can be a rule's host
        bounds = [max((len(h.encode()) for h, _ in best), default=0), max((h.count(".") + 1 for h, _ in best), default=0)]
        with open(path, "wb") as f:
            np.array([len(rows), len(lengths), *bounds], "<u8").tofile(f)
            for x in (keys, ends, hosts, blocks, lengths):
                x.tofile(f)
            f.write(b"".join(r[1] for r in rows))

    def __init__(self, path: str) -> None:
        n, m, self.longest, self.labels = (int(x) for x in np.fromfile(path, "<u8", 4))
        at = 32
        parts = []
        for kind, count in (("<u8", n), ("<u8", n + 1), ("<u4", n), ("<u4", n), ("<u4", m)):
            parts.append(np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind))
            at += parts[-1].nbytes
        self.keys, self.ends, self.hosts, self.blocks, self.lengths = parts
        self.heap = np.memmap(path, np.uint8, "r", at) if n else np.zeros(0, np.uint8)

    def probe(self, hosts: list[str], paths: list[str]) -> list[tuple[int, int, bool, str | None, str | None]]:
        """(length, length of the host, whether it blocks, rule string, verdict) of each url's longest rule; -1 and None
        where no rule fits."""
        owner: list[int] = []
        texts: list[bytes] = []
        split: list[int] = []
        lengths = self.lengths.tolist()
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            h, p = host.encode("utf-8", "surrogatepass"), path.encode("utf-8", "surrogatepass")
            begins = [p[:n] for n in lengths if n <= len(p)]
            # the host and its suffixes at dots, shortest first, as far as the rules' hosts reach
            at = len(h)
            for _ in range(self.labels if h else 0):
                at = h.rfind(b".", 0, at) if at > 0 else -1
                if len(h) - at - 1 > self.longest:
                    break
                if at + 1 < len(h):
                    for b in begins:
                        owner.append(i)
                        texts.append(h[at + 1 :] + b)
                        split.append(len(h) - at - 1)
                if at < 0:
                    break
        best: list[tuple[int, int, bool, str | None, str | None]] = [(-1, -1, False, None, None)] * len(hosts)
        if not texts or not len(self.keys):
            return best
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        low, high = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        for c in np.flatnonzero(high > low):
            for k in range(int(low[c]), int(high[c])):
                if int(self.hosts[k]) == split[c] and self.heap[int(self.ends[k]) : int(self.ends[k + 1])].tobytes() == texts[c]:
                    rank = (len(texts[c]), split[c])
                    if rank > best[owner[c]][:2]:
                        blocks = bool(self.blocks[k])
                        best[owner[c]] = (*rank, blocks, texts[c].decode("utf-8", "surrogatepass"), "block" if blocks else "allow")
        return best


def ship(spark: SparkSession, rules: list[tuple[str, str, str]]) -> list[str]:
    """Writes the rules' arrays and hands them to every executor through Spark; returns the files' names there.

    Only the driver reads the folder that they are written to, below its own folder for temporary files.
    """
    rules = sorted(set(rules))
    folder = os.path.join(tempfile.gettempdir(), "gridprep-rules")
    os.makedirs(folder, exist_ok=True)
    names = []
    for k in range(0, len(rules), FILE_RULES):
        part = rules[k : k + FILE_RULES]
        # Spark wants equal names to have equal paths, so a list has one path in the driver's temp folder
        names.append("rules-" + hashlib.sha256(repr(part).encode()).hexdigest()[:20] + ".bin")
        path = os.path.join(folder, names[-1])
        if not os.path.exists(path):
            DigestArray.write(f"{path}.{os.getpid()}", part)
            os.replace(f"{path}.{os.getpid()}", path)
        spark.sparkContext.addFile(path)
    return names


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every url; ``rules``: (host, path, allow or block).

    A url that no rule fits gets a null rule and the ``default`` verdict; so do null urls, whose host and path are empty.
    Rules of equal length: the one with the longer host; of equal rules, block. Repeated rows give a row each; other
    columns are ignored. An empty rule list gives every url the default.
    """
    names = ship(pages.sparkSession, rules)
    opened: dict[str, DigestArray] = {}

    @F.pandas_udf("rule string, verdict string")
    def probed(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        hosts, paths = host.tolist(), path.tolist()
        best: list[tuple] = [(-1, -1, False, None, None)] * len(hosts)
        for name in names:
            if name not in opened:
                opened[name] = DigestArray(SparkFiles.get(name))
            best = [max(b, found, key=lambda x: x[:3]) for b, found in zip(best, opened[name].probe(hosts, paths), strict=True)]
        return pd.DataFrame({"rule": pd.Series([b[3] for b in best], dtype=object), "verdict": pd.Series([b[4] for b in best], dtype=object)})

    host, path = host_path(F.col("url").cast("string"))
    found = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("found", probed("host", "path"))
    return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict"))
