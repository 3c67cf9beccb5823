"""Secret scans: candidates by patterns, false positives removed by a random forest.

A candidate is a value assigned to a name that speaks of secrets, a value of a well-known format, or a long run
of letters and digits.  The forest judges it by its length, its character classes and transitions, how much of it
dictionary words cover, the path it is in and the words around it.  It is trained here, on labelled findings:
a table given by the user, or findings of known provenance (see ``known_findings``).  The dictionary and the letter
transitions are counted over all documents (see ``ordinary_language``); every text is scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, slices, small_batches, table, tidied, utf8_buffer, written

SHARE, SEEN = 0.001, 3  # of the documents of a language or source; fewer than SEEN may be chance
TREES, DEPTH, LEAF = 25, 9, 3
AROUND = 48
PIECE = 64
MARK = "[SECRET]"

SPEAKING = r"(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credential)"
ASSIGNED = re.compile(SPEAKING + r"[\w-]{0,32}[\"']?\s{0,4}(?:=>|:=|[:=])\s{0,4}[\"']?([^\s\"',;<>]{6,})", re.I)
# to the END line; if that is missing, to the end of the lines in base64, of which the last may be short
BETWEEN = r"(?:\\[nrt]|[\s\"',;>#*|]|(?<=\s)\+(?=\s))"
HEADER = r"(?:Proc-Type|DEK-Info): [^\s\\]+(?: [^\s\\]+)*"
BASE64 = rf"{BETWEEN}++[A-Za-z0-9+/]{{16,}}+={{0,2}}"
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,20}PRIVATE KEY-----"
    rf"|(?:{BETWEEN}++{HEADER})*(?:{BASE64})++(?:(?:\r?\n|\\n){BETWEEN}*+[A-Za-z0-9+/]{{1,15}}={{0,2}}(?=[\s\"',\\]|$))?|)"
)
# fixed values: the public formats of keys
FORMATS = {
    "aws": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github": r"\bgh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"\bAIza[0-9A-Za-z_-]{35}",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": PRIVATE_KEY,
}
KNOWN = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in FORMATS.items()))
KNOWN_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "eyJ", "-----BEGIN ")
SHORTEST = 6  # of an assigned value
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# what no candidate is without, for Arrow's linear-time matcher; an i without regard to case is also dotted or dotless in Python
SUSPICIOUS = "|".join(["(?i:" + SPEAKING.replace("i", "[i\u0130\u0131]") + ")", *KNOWN_STARTS, r"[A-Za-z0-9+/_-]{20}"])
NEAR_SECRET = re.compile(SPEAKING + r"|bearer|authoriz", re.I)
NEAR_OTHER = re.compile(
    r"example|sample|dummy|placeholder|your[_-]|test|commit|sha\d*|md5|checksum|digest|hash|uuid|guid|integrity|revision|etag", re.I
)
PATH = re.compile(r"(?:^|[\s\"'(=])(?:https?://|\.{0,2}/|[A-Za-z]:\\)[^\s\"']*$")
PATH_OTHER = re.compile(r"test|spec|fixture|example|sample|docs?/|\.lock|\.md|vendor|node_modules|\.min\.", re.I)
FINDING = "start int, stop int, kind string, score double, secret boolean, value_sha256 string"


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind), by place, without overlaps.

    A value of a well-known format comes whole, wherever it is; what is left of an assigned value around it, and of a
    long run around both, are candidates of their own if the rule of their kind holds for them.
    """
    formats = any(start in text for start in KNOWN_STARTS)
    known = [(m.start(), m.end(), m.lastgroup) for m in KNOWN.finditer(text)] if formats else []
    signs = "=" in text or ":" in text
    assigned = _around([m.span(1) for m in ASSIGNED.finditer(text)] if signs else [], known)
    named = sorted(known + [(a, b, "assigned") for a, b in assigned if b - a >= SHORTEST])
    long = []
    for a, b in _around([m.span() for m in RUN.finditer(text)], named):
        value = text[a:b]
        if RUN.fullmatch(value) and any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            long.append((a, b, "long"))
    return sorted(named + long)


def suspicious(texts: pa.Array) -> np.ndarray:
    """Places of the texts that may hold a candidate; the others have none."""
    return np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, SUSPICIOUS), False).to_numpy(zero_copy_only=False))


def _around(spans: list[tuple[int, int]], taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """What the taken spans leave of each span; both are sorted and without overlaps of their own."""
    at = 0
    for start, stop in spans:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        k = at
        while k < len(taken) and taken[k][0] < stop:
            if taken[k][0] > start:
                yield start, taken[k][0]
            start = max(start, taken[k][1])
            k += 1
        if start < stop:
            yield start, stop


def _classes() -> np.ndarray:
    """Class of each byte: 26 letters whatever their case, digits, other."""
    of = np.full(256, 27)
    for i, c in enumerate(string.ascii_lowercase):
        of[ord(c)] = of[ord(c.upper())] = i
    of[[ord(c) for c in string.digits]] = 26
    return of


@dataclass
class Language:
    """What ordinary text looks like: words, and how letters follow each other."""

    words: set = field(default_factory=set)
    transitions: np.ndarray = field(default_factory=lambda: np.full((28, 28), -math.log(28)))

    def coverage(self, value: str) -> float:
        """Share of the letters in dictionary words of four letters or more, taken greedily."""
        low, covered, at = value.lower(), 0, 0
        while at < len(low):
            for n in range(min(12, len(low) - at), 3, -1):
                if low[at : at + n] in self.words:
                    covered += n
                    at += n
                    break
            else:
                at += 1
        return covered / max(1, len(low))


def pair_counts(words: list[str] | pa.Array, documents: list[int] | np.ndarray) -> np.ndarray:
    """How often a class of bytes follows another in the words, each counted once for each of its documents."""
    if isinstance(words, list):
        words = pa.array([word.encode("utf-8", "replace") for word in words], pa.large_binary())
    counts = np.zeros(28 * 28, np.int64)
    data, offsets = utf8_buffer(words)
    if len(data):
        of = _classes()[data]
        each = np.repeat(np.asarray(documents, np.int64), np.diff(offsets))
        inside = np.ones(len(data), bool)  # not the last byte of a word
        inside[offsets[1:][offsets[1:] > 0] - 1] = False
        at = np.flatnonzero(inside)
        np.add.at(counts, of[at] * 28 + of[at + 1], each[at])
    return counts.reshape(28, 28)


def language_of(words: list[str], pairs: np.ndarray) -> Language:
    """From the words of the dictionary and the counts of pairs of classes."""
    counts = pairs + 1.0
    return Language(set(words), np.log(counts / counts.sum(1, keepdims=True)))


def pieces(value: str) -> list[str]:
    """A value and, if it is longer than what the forest learns from, overlapping pieces that cover it to its end."""
    if len(value) <= 2 * PIECE:
        return [value]
    return [value, *(value[at : at + PIECE] for at in range(0, len(value) - PIECE // 2, PIECE // 2))]


def features(value: str, before: str, after: str, path: str, language: Language, length: int | None = None) -> list[float]:
    """Of a value, or of a piece of one of ``length`` characters."""
    n = len(value)
    raw = np.frombuffer(value.encode("utf-8", "replace"), np.uint8)
    of = _CLASS[raw]
    share = np.bincount(raw, minlength=256) / len(raw)
    share = share[share > 0]
    kinds = np.where(of < 26, np.where(raw < 97, 0, 1), np.where(of == 26, 2, 3))
    steps = language.transitions[of[:-1], of[1:]].mean() if len(of) > 1 else 0.0
    own_path = bool(PATH.search(before)) or "/" in value[:-2].strip("/") and kinds.tolist().count(2) < n / 8
    return [
        length or n,
        *(float((kinds == k).mean()) for k in range(4)),
        float(-(share * np.log2(share)).sum()),
        len(share) / len(raw),
        float(steps),
        float((kinds[1:] != kinds[:-1]).mean()) if n > 1 else 0.0,
        language.coverage(value),
        float(not set(value) - set("0123456789abcdefABCDEF")),
        float(own_path),
        float(bool(PATH_OTHER.search(path))),
        float(bool(NEAR_SECRET.search(before))),
        float(bool(NEAR_OTHER.search(before) or NEAR_OTHER.search(after[:16]) or NEAR_OTHER.search(value))),
        float(bool(re.search(r"[:=]\s*[\"']?$", before))),
        float(before[-1:] in "\"'" and before != ""),
        float(bool(KNOWN.match(value))),
    ]


_CLASS = _classes()


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, left, right, share of secrets."""

    trees: list = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 9) -> Forest:
        rng = np.random.default_rng(seed)
        for _ in range(TREES if len(x) else 0):
            rows = rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            self._grow(x[rows], y[rows].astype(float), nodes, 0, rng)
            self.trees.append(np.array(nodes))
        return self

    def _grow(self, x, y, nodes, depth, rng) -> int:
        at = len(nodes)
        nodes.append([-1, 0, 0, 0, y.mean()])
        if depth == DEPTH or len(y) < 2 * LEAF or y.min() == y.max():
            return at
        best = (np.inf, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1])) + 1), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            left = np.arange(1, len(y))
            p, q = ones[:-1] / left, (ones[-1] - ones[:-1]) / (len(y) - left)
            impurity = left * p * (1 - p) + (len(y) - left) * q * (1 - q)
            impurity[(v[1:] == v[:-1]) | (left < LEAF) | (len(y) - left < LEAF)] = np.inf
            k = int(impurity.argmin())
            if impurity[k] < best[0]:
                best = (impurity[k], f, v[k])  # a midpoint of neighbouring numbers may be the upper one
        if best[1] >= 0:
            here = x[:, best[1]] <= best[2]
            left = self._grow(x[here], y[here], nodes, depth + 1, rng)
            right = self._grow(x[~here], y[~here], nodes, depth + 1, rng)
            nodes[at][:4] = [best[1], best[2], left, right]
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets; 1 without trees: nothing is known to be a false positive."""
        if not self.trees or not len(x):
            return np.ones(len(x))
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), int)
            while True:
                f = tree[at, 0].astype(int)
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                low = x[inner, f[inner]] <= tree[at[inner], 1]
                at[inner] = np.where(low, tree[at[inner], 2], tree[at[inner], 3]).astype(int)
            total += tree[at, 4]
        return total / len(self.trees)


def known_findings(n: int = 1200, seed: int = 4) -> list[tuple[str, str, str, str, int]]:
    """(before, value, after, path, label) of known provenance: freshly drawn keys as they are written in files and
    logs (1), and what scanners take for keys: digests, identifiers, placeholders, paths, names (0)."""
    rng = np.random.default_rng(seed)
    draw = lambda letters, k: "".join(rng.choice(list(letters), k))
    pick = lambda *of: of[rng.integers(len(of))]
    hexa, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    syllables = ["tion", "er", "an", "the", "lich", "ment", "ing", "que", "ver", "data", "user", "name", "page", "list", "item", "view"]
    out = []
    for _ in range(n):
        name = pick("token", "secret", "password", "api_key", "apikey", "access_key", "client_secret", "auth_token", "passwd")
        sign = pick(' = "', "=", ": ", ': "', " := '", "='", '": "', " = ")
        value = pick(
            draw(hexa, int(pick(32, 40, 64))), draw(alnum, int(rng.integers(16, 64))), draw(alnum + "+/", 40), draw(alnum + "!#%&*", 14),
            "AKIA" + draw(string.ascii_uppercase + string.digits, 16), "ghp_" + draw(alnum, 36), "AIza" + draw(alnum, 35),
        )
        word = pick("and ", "the ", "config: ", "", "export ", "\n")
        out.append((word + name.upper() + sign if rng.random() < 0.2 else word + name + sign, value, pick('"', "'", "\n", " then"), pick("", "src/app.py", "src3", "prod.env"), 1))
        kind = rng.integers(8)
        long_name = "".join(rng.choice(syllables, int(rng.integers(5, 9))))
        uuid = "-".join(draw(hexa, k) for k in (8, 4, 4, 4, 12))
        before, value = [
            (pick("commit ", "sha256: ", "md5=", 'integrity="sha512-', "checksum "), draw(hexa, int(pick(32, 40, 64)))),
            (pick("id=", "uuid ", "guid: ", "request "), uuid),
            (name + sign, pick("your_" + name + "_here", "xxxxxxxxxxxxxxxx", "example" + draw("0123456789", 4), "changeme123", "<" + name + ">", "None", "process.env.KEY")),
            (pick("see ", "/usr/lib/", "https://host/"), "/".join(rng.choice(syllables, 6)) + str(rng.integers(1000))),
            (pick("def ", "", "the "), long_name + str(rng.integers(100))),
            (pick("number ", "phone ", "account ", "order "), pick("DE", "GB", "N") + draw("0123456789", 20)),
            (name + pick(" : ", ": ", "="), long_name),
            (pick("the ", "und ", "- "), "-".join(rng.choice(syllables, 7)) + "-" + str(rng.integers(10))),
        ][kind]
        out.append((before, value, pick('"', " ", "\n"), pick("", "tests/test_a.py", "docs/readme.md", "src3", "yarn.lock"), 0))
    for _ in range(n // 4):  # keys of well-known formats where no name speaks of them, and embedded data in such places
        value = pick(
            "AKIA" + draw(string.ascii_uppercase + string.digits, 16), "ghp_" + draw(alnum, 36), "AIza" + draw(alnum, 35),
            "xoxb-" + draw(string.digits, 12) + "-" + draw(alnum, 24), "eyJ" + ".".join(draw(alnum, k) for k in (33, 60, 43)),
        )
        before = pick("", "the ", "\n", "see https://host.example/files/", "/", "/usr/lib/" + pick(*syllables) + "/", draw(alnum + "+/", 40) + "/", "id=", "- ")
        after, path = pick('"', " ", "\n", "/", "/" + draw(alnum, 20)), pick("", "src/app.py", "docs/readme.md", "src3")
        out.append((before, value, after, path, 1))
        out.append((before, draw(alnum + "+/", int(rng.integers(20, 120))), after, path, 0))
    return out


def ordinary_language(docs: DataFrame) -> Language:
    """What all documents have in common, those without a text aside.

    Words are counted once a document, by language and by source where the columns ``lang`` and ``source`` are there.
    The dictionary has those in at least ``SHARE`` of the documents, and in ``SEEN``, of a language or a source; the
    transitions come from all words.  Only the dictionary and one matrix of counts pass the driver.
    """
    groups = [c for c in ("lang", "source") if c in docs.columns]
    # the empty word is in every document: it counts them
    words = F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower("text"), r"[^\p{L}]+")))
    each = docs.select(*groups, F.explode(words).alias("word"))
    counted = written(each.groupBy(*groups, "word").agg(F.count("*").alias("n")), "words")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((28, 28), np.int64)
        for batch in batches:
            total += pair_counts(batch.column(0), batch.column(1).to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.reshape(-1)[at])], names=["pair", "n"])

    total = np.zeros(28 * 28, np.int64)
    for pair, n in counted.select("word", "n").mapInArrow(tidied(pairs), "pair int, n long").groupBy("pair").agg(F.sum("n")).collect():
        total[pair] = n
    chosen = []
    for group in groups or [None]:
        keys = [group] if group else []
        by = counted.groupBy(*keys, "word").agg(F.sum("n").alias("n")) if keys else counted
        sizes = by.where("word = ''").select(*(F.col(k).alias("whose") for k in keys), F.col("n").alias("documents"))
        by = by.where(F.length("word").between(4, 24) & (F.col("n") >= SEEN))
        by = by.join(sizes, F.col(group).eqNullSafe(F.col("whose"))) if group else by.crossJoin(sizes)
        chosen.append(by.where(F.col("n") >= SHARE * F.col("documents")).select("word"))
    words = chosen[0] if len(chosen) == 1 else chosen[0].union(chosen[1])
    return language_of([r["word"] for r in words.distinct().collect()], total.reshape(28, 28))


def train(findings: list[tuple[str, str, str, str, int]], language: Language) -> Forest:
    x = np.array([features(v, b, a, p, language) for b, v, a, p, _ in findings])
    return Forest().fit(x, np.array([f[4] for f in findings]))


def findings_in(text: str | None, path: str | None, language: Language, forest: Forest) -> list[tuple]:
    """(start, stop, kind, score) of a text's candidates; the highest score of a value's pieces decides."""
    if not text:
        return []
    spans = candidates(text)
    if not spans:
        return []
    x, first = [], []
    for a, b, _ in spans:
        before, after = text[max(0, a - AROUND) : a], text[b : b + AROUND]
        first.append(len(x))
        x += [features(piece, before, after, path or "", language, b - a) for piece in pieces(text[a:b])]
    scores = np.maximum.reduceat(forest.predict(np.array(x)), first)
    return [(a, b, kind, float(s)) for (a, b, kind), s in zip(spans, scores)]


def _sent(docs: DataFrame, language: Language, forest: Forest):
    small_batches(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast((sorted(language.words), language.transitions, forest.trees))


def scan(
    docs: DataFrame, language: Language, forest: Forest, path_column: str | None = None, least: float = 0.5
) -> DataFrame:
    """doc_id and, for each candidate, its place (in characters), kind, score, verdict and the digest of its value.

    Null and empty texts have no candidates.  Rows are independent, so repeated rows give repeated findings; the
    other columns are ignored.
    """
    sent = _sent(docs, language, forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, transitions, trees = sent.value
        own, trained = Language(set(words), transitions), Forest(trees)
        for batch in slices(batches):
            batch = batch.take(pa.array(suspicious(batch.column(1))))
            rows = []
            for doc_id, text, path in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for a, b, kind, score in findings_in(text, path, own, trained):
                    digest = hashlib.sha256(text[a:b].encode("utf-8", "replace")).hexdigest()
                    rows.append((doc_id, a, b, kind, score, score >= least, digest))
            columns = list(zip(*rows)) or [()] * 7
            types = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.bool_(), pa.string()]
            names = ["doc_id", "start", "stop", "kind", "score", "secret", "value_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    path = F.col(path_column).cast("string") if path_column else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", path.alias("path"))
    return rows.mapInArrow(tidied(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FINDING}")


def redact(docs: DataFrame, language: Language, forest: Forest, path_column: str | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``MARK``, and ``n_chars``, if there, set anew.  No row goes."""
    names = docs.columns
    sent = _sent(docs, language, forest)
    path_name = free_name(docs, "own_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, transitions, trees = sent.value
        own, trained = Language(set(words), transitions), Forest(trees)
        at = names.index("text")
        for batch in slices(batches):
            before = batch.column(at).cast(pa.string())
            places, changed = np.arange(len(before)), []
            for i in suspicious(before):
                text, path = before[i].as_py(), batch.column(len(names))[i].as_py()
                secrets = [(a, b) for a, b, _, score in findings_in(text, path, own, trained) if score >= least]
                for a, b in reversed(secrets):
                    text = text[:a] + MARK + text[b:]
                if secrets:
                    places[i] = len(before) + len(changed)
                    changed.append(text)
            texts = pa.concat_arrays([before, pa.array(changed, pa.string())]).take(pa.array(places)) if changed else before
            columns = [texts if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    path = F.col(path_column).cast("string") if path_column else F.lit(None).cast("string")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = docs.withColumn(path_name, path).mapInArrow(tidied(run), kinds)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out


def trained_scanner(docs: DataFrame) -> tuple[Language, Forest]:
    language = ordinary_language(docs)
    return language, train(known_findings(), language)


def op1_secrets(spark, sf_dir):
    """Every candidate of every document, with the forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    language, forest = trained_scanner(docs)
    return scan(docs, language, forest, path_column="source")
