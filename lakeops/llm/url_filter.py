"""URL filter: all glob rules at once by a bit-parallel wildcard automaton.

A glob is made of literal characters, ``?`` (one character but ``/``), ``*`` (any run without ``/``) and ``**`` (any run), and must match the
whole canonical URL: the lower-cased host followed by the path.  Every glob position is one bit of a multiword mask.  A step of Shift-And moves all
live positions over the next character of the URL; wildcard runs keep their bit by a second mask, and an empty run is entered by one more shift of the bits that stand
on runs (wildcards side by side are parsed as one, so one shift is enough).  Batches of URLs advance together, one character at a time.

A site rule such as ``example.net/en/`` becomes two globs (the host, and its subdomains).  The longest matching site rule decides; without one a
URL is blocked if a blocking glob matches, and allowed otherwise.  Null URLs and URLs without ``://`` have an empty host and path.

The blocking globs are a list of any length, by default ``BLOCKING_GLOBS``; ``read_globs`` takes one from a file of lines.  Every task holds the whole automaton, some bytes per
character of the list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

WORD = 64
ROWS_AT_ONCE = 2048

# Site rules: (host and path, verdict).
SITE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# What the default globs are formed of: words in hosts, words that are a part of the path, file endings, and parts of hosts.
HOST_WORDS = (
    "spam-farm cheap-pills casino viagra cialis payday-loan poker-online free-ringtones replica-watches essay-writing link-farm seo-links hot-singles xxx porn sexcam escort "
    "torrent warez keygen crackz proxy-list bulk-mail get-rich click-bait"
).split()
PATH_PARTS = (
    "wp-login.php wp-admin xmlrpc.php cgi-bin phpmyadmin login signin signup register logout cart checkout basket wishlist account password-reset unsubscribe calendar ical "
    "print-view trackback pingback feed rss atom share.php redirect.php out.php click.php ad-click adserver banners popunder sitemap.xml robots.txt"
).split()
ENDINGS = (
    "exe msi dmg iso apk deb rpm jar zip rar 7z gz tgz bz2 xz bin dll torrent swf mp3 mp4 avi mkv mov wmv flac wav ogg webm jpg jpeg png gif bmp svg webp ico tif tiff css js "
    "woff woff2 ttf eot psd ai eps doc docx xls xlsx ppt pptx csv sql bak log map min.js"
).split()
HOST_PARTS = "ads adserver tracker tracking click clicks banner banners pixel beacon affiliate popads".split()


def default_globs() -> tuple[str, ...]:
    """Some two hundred globs: words anywhere in the host, hosts that serve adverts, path parts and file endings."""
    hosts = [f"*{w}*/**" for w in HOST_WORDS] + [g for p in HOST_PARTS for g in (f"{p}.*/**", f"*.{p}.*/**")]
    return tuple(hosts + [g for p in PATH_PARTS for g in (f"*/{p}", f"*/**/{p}", f"*/{p}/**", f"*/**/{p}/**")] + [f"*/**.{e}" for e in ENDINGS])


# Globs that block a URL no site rule decides.
BLOCKING_GLOBS = default_globs()


def read_globs(path: str) -> tuple[str, ...]:
    """One glob a line; empty lines and lines that start with # do not count."""
    with open(path, encoding="utf-8") as lines:
        return tuple(x for x in map(str.strip, lines) if x and not x.startswith("#"))


@dataclass(frozen=True)
class Rule:
    glob: str
    site: int | None  # index into the site rules, or None for a blocking glob


def site_globs(rules: tuple[tuple[str, str], ...]) -> list[Rule]:
    out = []
    for k, (rule, _) in enumerate(rules):
        literal = re.sub(r"([*?\\])", r"\\\1", rule)
        out += [Rule(literal + "**", k), Rule("*." + literal + "**", k)]
    return out


def tokens(glob: str) -> list[str]:
    """Literal characters as themselves, wildcards as "any", "run", "runs"."""
    out = []
    for m in re.finditer(r"\\(.)|\*+|\?|(.)", glob, re.S):
        out.append(m[1] or m[2] or ("any" if m[0] == "?" else "run" if m[0] == "*" else "runs"))
    return out


class Automaton:
    """Masks of all globs: bit p is live if the text so far matches the first tokens of a glob up to the one before position p."""

    def __init__(self, globs: list[str]):
        lists = [tokens(g) for g in globs]
        bits = sum(len(t) + 1 for t in lists)
        self.words = -(-bits // WORD) or 1
        self.start, self.final, self.runs = self._mask(), [], self._mask()
        literal: dict[str, np.ndarray] = {}
        self.any, self.keep, self.keep_slash = self._mask(), self._mask(), self._mask()
        bit = 0
        for parsed in lists:
            self._set(self.start, bit)
            for token in parsed:
                if token in ("run", "runs"):
                    self._set(self.runs, bit)
                    self._set(self.keep, bit)
                    if token == "runs":
                        self._set(self.keep_slash, bit)
                elif token == "any":
                    self._set(self.any, bit)
                else:
                    self._set(literal.setdefault(token, self._mask()), bit)
                bit += 1
            self.final.append(bit)
            bit += 1
        # Code points that no glob names share one class.
        self.classes = {c: k + 1 for k, c in enumerate(sorted(literal))}
        self.step = np.stack([self.any, *(literal[c] | (self.any if c != "/" else 0) for c in sorted(literal))])
        stays = [self.keep if c != "/" else self.keep_slash for c in sorted(literal)]
        self.stay = np.stack([self.keep, *stays])
        if "/" not in self.classes:
            self.classes["/"] = len(self.step)
            self.step, self.stay = np.vstack([self.step, self._mask()]), np.vstack([self.stay, self.keep_slash])

    def _mask(self) -> np.ndarray:
        return np.zeros(self.words, np.uint64)

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // WORD] |= np.uint64(1 << bit % WORD)

    @staticmethod
    def _shift(live: np.ndarray) -> np.ndarray:
        out = live << np.uint64(1)
        out[:, 1:] |= live[:, :-1] >> np.uint64(WORD - 1)
        return out

    def _enter(self, live: np.ndarray) -> np.ndarray:
        """Empty runs: whoever stands on a run also stands behind it."""
        return live | self._shift(live & self.runs)

    def match(self, texts: list[str]) -> np.ndarray:
        """A Boolean for each text and glob."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")  # longest first: those that still run are the first rows
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        classes, starts, lengths = self._class_of(codes), (np.cumsum(lengths) - lengths)[order], lengths[order]
        live = self._enter(np.tile(self.start, (len(texts), 1)))
        for at in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -at, "left"))
            now = classes[starts[:active] + at]
            state = live[:active]
            live[:active] = self._enter(self._shift(state & self.step[now]) | (state & self.stay[now]))
        out = np.zeros((len(texts), len(self.final)), bool)
        for g, bit in enumerate(self.final):
            out[order, g] = (live[:, bit // WORD] >> np.uint64(bit % WORD)) & np.uint64(1)
        return out

    def _class_of(self, codes: np.ndarray) -> np.ndarray:
        named = np.array(sorted(map(ord, self.classes)), np.uint32)
        number = np.array([self.classes[chr(c)] for c in named], np.int64)
        at = np.minimum(np.searchsorted(named, codes), len(named) - 1)
        return np.where(named[at] == codes, number[at], 0)


def host_and_path(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub(r"[A-Z]+", lambda m: m[0].lower(), host), path


def judge_urls(
    df: DataFrame, url: str, keep: list[str], rules: tuple[tuple[str, str], ...] = SITE_RULES, blocking: tuple[str, ...] = BLOCKING_GLOBS
) -> DataFrame:
    """The columns ``keep``, and host, path, the deciding site rule (or null) and the verdict (allow or block) of every URL."""
    schema = StructType([*df.select(*keep).schema.fields, *(StructField(c, StringType()) for c in ("host", "path", "rule", "verdict"))])
    all_rules = site_globs(rules) + [Rule(g, None) for g in blocking]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([r.glob for r in all_rules])
        by_length = sorted(range(len(rules)), key=lambda k: -len(rules[k][0]))
        of_site = {k: [g for g, r in enumerate(all_rules) if r.site == k] for k in by_length}
        others = [g for g, r in enumerate(all_rules) if r.site is None]
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                parts = [host_and_path(u) for u in batch.column(batch.num_columns - 1).to_pylist()]
                matched = automaton.match([h + p for h, p in parts])
                rule, verdict = [], []
                blocked = matched[:, others].any(axis=1)
                sites = np.stack([matched[:, of_site[k]].any(axis=1) for k in by_length], axis=1) if by_length else np.zeros((len(parts), 0), bool)
                for n, held in enumerate(sites):
                    site = by_length[int(held.argmax())] if held.any() else None
                    rule.append(None if site is None else rules[site][0])
                    verdict.append(rules[site][1] if site is not None else "block" if blocked[n] else "allow")
                columns = [pa.array(c, pa.string()) for c in ([h for h, _ in parts], [p for _, p in parts], rule, verdict)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), *columns], schema.names)

    return df.select(*keep, F.col(url).cast("string").alias("__url")).mapInArrow(run, schema)
