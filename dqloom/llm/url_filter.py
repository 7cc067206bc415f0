"""URL filters: rules for hosts and paths, else a logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_bytes, tidy

#: Rules of the production list: action, host and path as one string.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Words of the labelled URL table: what a training corpus can do without, and topics.
BLOCKED_WORDS = """adult ads adserver banner betting bingo blackjack bonus cams cash casino cheap clicks coupon cracked dating deals discount doorway drugs erotic escort fake
followers free gamble hookup jackpot keygen linkfarm lottery loans lucky malware meds naked nude odds payday pharmacy phish pills poker popup porn prize promo replica roulette
scam serial sexy slots spam spammer sweepstakes torrent tracker viagra virus warez webcam winner xxx""".split()
ALLOWED_WORDS = """academy agriculture archive article astronomy atlas biology botany bridge builder chemistry children church climate college community concert council culture dance
dictionary economy education encyclopedia energy engineering family festival fisheries forest gallery garden geography glossary health history hospital institute journal
kitchen language law lecture library literature magazine manual maths medicine mountain museum music nature news novel ocean opera painting parliament
philosophy physics poetry politics railway recipes report research river school science sculpture society sport statistics story teacher theatre transport travel tutorial
university village weather wiki""".split()
BUCKETS = 1 << 14
SIZES = (3, 4, 5)
BLOCK_SHARE = 0.7  # weight of the blocked rows in training: a URL has one telling word among neutral parts


def labelled_urls() -> list[tuple[str, str, int]]:
    """host, path and 1 (block) or 0: the small labelled table. Both classes have the same forms of URLs; hosts of made-up syllables are allowed."""
    tlds, rows = ("biz", "co.uk", "com", "eu", "info", "net", "online", "org"), []

    def plain(i: int) -> str:
        return ("", "/", f"/p{i * 13 % 89}.html", f"/{i * 61 % 9973}", f"/x/{i * 37 % 997}/", f"/{'abdfkmz'[i % 7]}{'aeiou'[i % 5]}/{i * 17 % 9001}")[i % 6]

    for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        n = len(words)
        for i, w in enumerate(words):
            p, q, tld = words[(i * 7 + 3) % n], words[(i * 11 + 5) % n], tlds[i % len(tlds)]
            rows += [(h, path, label) for h, path in (
                (f"{w}{p}.{tld}", plain(i)), (f"www.{q}-{w}.{tld}", plain(i + 1)), (f"{w}-{p}.pages{i % 9}.{tld}", plain(i + 2)), (f"my{w}24.{tld}", plain(i + 3)), (f"{w}.{tld}", plain(i + 4)),
                (f"www.{w}s.hosted.{tld}", plain(i + 5)), (f"m.{q}-{w}.server.{tld}", plain(i + 2)), (f"blog.{w}-{q}.sites{i % 7}.{tld}", plain(i + 3)), (f"pages.host{i % 9}.{tld}", f"/~{w}/{q}"), (f"{p}.{tld}", f"/2019/0{i % 9 + 1}/{w}-{q}"),
            )]
    onsets, ends = ("b", "br", "d", "f", "g", "gl", "k", "l", "m", "n", "p", "r", "s", "st", "t", "v"), ("a", "an", "e", "el", "i", "in", "o", "or", "u", "um")
    for i in range(800):
        made = "".join(onsets[(i * k + i // 16) % 16] + ends[(i * (k + 2) + i // 10) % 10] for k in (1, 3, 5)[: 2 + i % 2])
        rows.append((("", "www.", "m.")[i % 3] + f"{made}.{tlds[i % len(tlds)]}", plain(i // 3), 0))
    return rows


def grams(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every character n-gram of host and path (whose grams never meet), and each row's number of them."""
    rows, buckets = [], []
    for view, col in enumerate((hosts, paths)):
        data, offsets = text_bytes(pa.compute.binary_join_element_wise("", pa.compute.fill_null(col, ""), "", "\x02"))
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for n in SIZES:
            m = len(data) - n + 1
            if m <= 0:
                continue
            code = np.full(m, view * 8 + n, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for j in range(n):
                    code = code * np.uint64(257) + data[j : j + m]
            fits = row[:m] == row[n - 1 :]
            buckets.append((mix64(code[fits]) % np.uint64(BUCKETS)).astype(np.int64))
            rows.append(row[:m][fits])
    rows_, buckets_ = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, buckets))
    return buckets_, rows_, np.maximum(1, np.bincount(rows_, minlength=len(hosts)))


def block_probability(weights: np.ndarray, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
    buckets, rows, count = grams(hosts, paths)
    z = np.bincount(rows, weights=weights[buckets], minlength=len(hosts)) / np.sqrt(count) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(rows: list[tuple[str, str, int]], steps: int = 4000, rate: float = 8.0, decay: float = 5e-5) -> np.ndarray:
    """Weights of the buckets and, last, the bias; full-batch gradient descent."""
    hosts, paths, y = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), np.array([r[2] for r in rows], float)
    buckets, at, count = grams(hosts, paths)
    scale = 1 / np.sqrt(count)
    share = np.where(y == 1, BLOCK_SHARE / max(1, y.sum()), (1 - BLOCK_SHARE) / max(1, (1 - y).sum()))
    weights = np.zeros(BUCKETS + 1)
    for _ in range(steps):
        z = np.bincount(at, weights=weights[buckets], minlength=len(y)) * scale + weights[-1]
        slope = (1 / (1 + np.exp(-z)) - y) * share
        weights[:-1] -= rate * (np.bincount(buckets, weights=(slope * scale)[at], minlength=BUCKETS) + decay * weights[:-1])
        weights[-1] -= rate * slope.sum()
    return weights


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Rules:
    """Rules by host: of those whose host is the url's or a parent of it, and whose path begins the url's path, the longest wins (of equally long ones, the last in order)."""

    def __init__(self, rules):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=True):
            at, slash, rest = rule.partition("/")
            self.by_host.setdefault(at, []).append((slash + rest, rule, action))

    def of_host(self, host: str) -> list[tuple[str, str, str]]:
        """path, rule and action of all rules for a host, the longest first."""
        found = list(self.by_host.get(host, ()))
        at = host.find(".")
        while at >= 0:
            found += self.by_host.get(host[at + 1 :], ())
            at = host.find(".", at + 1)
        return sorted(found, key=lambda r: (len(r[1]), r[1]), reverse=True)

    def of_urls(self, hosts: pa.Array, paths: pa.Array) -> list[tuple[str | None, str | None]]:
        """rule and action for each url, or nulls. Each host is looked up once."""
        coded = hosts.dictionary_encode()
        rules = [self.of_host(h) for h in coded.dictionary.to_pylist()]
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
        code = coded.indices.to_numpy()
        some = np.flatnonzero(np.array([bool(r) for r in rules], bool)[code]) if len(rules) else []
        for i, path in zip(some, paths.take(pa.array(some, pa.int64())).to_pylist(), strict=True):
            out[i] = next(((rule, action) for start, rule, action in rules[code[i]] if path.startswith(start)), (None, None))
        return out


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: list[tuple[str, str, int]] | None = None, threshold: float = 0.5, url: str = "url", key: str = "page_id") -> DataFrame:
    """Per row: key, host, path, rule, verdict (allow or block) and score (the method's probability of block).

    The longest rule that fits decides; without one, a score over threshold blocks and one equal to it allows. A null url, or one without
    ://, has an empty host and path, fits no rule and is scored as such. Repeated rows give repeated results, an empty
    table an empty one; other columns don't matter. labelled is a small table held on the driver; an empty one gives a score of
    one half to all. The list of rules, of any length, is held once by each Python worker.
    """
    spark = pages.sparkSession
    weights = spark.sparkContext.broadcast(train(labelled if labelled is not None else labelled_urls()))
    listed = spark.sparkContext.broadcast(Rules(rules))
    link = F.col(f"`{url}`").cast("string")
    source = pages.select(F.col(f"`{key}`").alias("key"), host_of(link).alias("host"), path_of(link).alias("path"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = block_probability(weights.value, batch.column(1), batch.column(2))
                found = listed.value.of_urls(batch.column(1), batch.column(2))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array([r for r, _ in found], pa.string()), pa.array([a for _, a in found], pa.string())], names=["key", "host", "path", "score", "rule", "action"])
        tidy()

    scored = source.mapInArrow(run, f"key {kind}, host string, path string, score double, rule string, action string")
    return scored.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("action", F.when(F.col("score") > threshold, "block").otherwise("allow")).alias("verdict"), "score")
