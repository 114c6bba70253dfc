"""Secret scans: candidates by shape, judged by a random forest over their look and what stands around them."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import ragged
from millrace.llm.common import column
from millrace.session import stage

#: Shortest run of key characters that is a candidate by itself; runs need a digit too.
RUN_CHARS = 16
#: Words kept in the word list.
DICTIONARY_WORDS = 20_000
#: Labelled findings that the forest is fitted to, at most.
LABELLED_ROWS = 4_000
TREES, DEPTH, SEED = 30, 8, 11
THRESHOLD = 0.5
MASK = "[SECRET]"

# Words that announce a credential, and words that announce something harmless.
CREDENTIAL_WORDS = ["token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "access_key", "auth", "authorization", "bearer", "basic", "credential", "credentials", "login", "passwort", "kennwort", "contraseña", "contrasena", "passe", "senha"]
HARMLESS_WORDS = ["example", "sample", "dummy", "placeholder", "test", "commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "id", "etag", "image", "order", "invoice", "card", "account", "phone", "serial", "file", "path", "version"]
PATH_WORDS = re.compile(r"test|example|sample|fixture|mock|docs?\b", re.IGNORECASE)

_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_NAMED = re.compile("(?i)(?:token|secret|passwo?r?d|passwort|kennwort|contrase(?:ñ|n)a|mot[ _]de[ _]passe|senha|pwd|api[_-]?key|access[_-]?key|auth|credentials?)[\"']?[ \t]{0,3}$".encode())
_VALUE = re.compile(rb"=?>?[ \t]{0,3}[\"']?([\x21\x23-\x26\x28-\x7e]{8,})")
#: What follows the scheme of an authorisation header, and the password in a URL.
_BEARER = re.compile(rb"(?i)\b(?:bearer|basic)[ \t]{1,3}([A-Za-z0-9._~+/=-]{8,})")
_IN_URL = re.compile(rb"\b[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@\"']{1,100}:([^\s/@\"']{4,200})@")
_KEY_RUN = re.compile(rb"[A-Za-z0-9+/=]{16,}+")
_BETWEEN = rb"(?:[\s\"',;>|#*]|\\+[nrt]|\+(?=\s)){0,40}+"
#: Header, PEM headers, lines of key characters, and the END line where it follows them.
_BLOCK = re.compile(
    rb"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:" + _BETWEEN + rb"[A-Za-z][A-Za-z-]{2,30}:[ \t][^\r\n\\]{0,200})*+"
    rb"(?P<body>(?:" + _BETWEEN + _KEY_RUN.pattern + rb")++)(?:" + _BETWEEN + rb"[A-Za-z0-9+/=]{0,15}" + _BETWEEN + rb"-----END [A-Z ]{0,30}PRIVATE KEY-----)?"
)
_WORD = re.compile(r"[^\W\d_]+(?:_key)?|\d+")
_URL_LEAD = re.compile(r"://[^\s/:@]+:$")
FEATURES = ["length", "digits", "upper", "lower", "symbols", "distinct", "transitions", "longest_run", "surprise", "dictionary", "path_like", "path_words", "credential_near", "assigned", "harmless_near", "placeholder"]


@dataclass
class Lexicon:
    """Words of the corpus, and how surprising each pair of letters is."""

    words: frozenset[str]
    surprise: np.ndarray


def _letter(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26


def learn_lexicon(docs: DataFrame, text_col: str = "text", group_col: str = "lang") -> Lexicon:
    """Words of 3 to 12 letters in at least two documents, and how often letters of such words follow each other, over all documents.

    Only the word list is bounded: the ``DICTIONARY_WORDS`` words with the largest share of the documents of some group (a
    language; without that column, of all), so that a small one has its words in it too. Counts have a map side.
    """
    group = F.coalesce(column(docs, group_col).cast("string"), F.lit("")) if group_col in docs.columns else F.lit("")
    parts = F.array_distinct(F.split(F.lower(column(docs, text_col).cast("string")), r"[^\p{L}]+"))
    words = docs.select(group.alias("g"), F.explode(F.filter(parts, lambda w: F.length(w).between(3, 12))).alias("w"))
    sizes = docs.groupBy(group.alias("g")).agg(F.count("*").alias("docs"))
    counts = words.groupBy("g", "w").agg(F.count("*").alias("n")).join(sizes, "g")
    counts = counts.groupBy("w").agg(F.sum("n").alias("n"), F.max(F.when(F.col("n") > 1, F.col("n") / F.col("docs"))).alias("share")).filter("n > 1")
    counts = stage(counts, "lexicon")
    top = counts.orderBy(F.desc_nulls_last("share"), F.desc("n"), "w").limit(DICTIONARY_WORDS).collect()
    plain = counts.select(F.regexp_replace("w", "[^a-z]", "{").alias("w"), F.log1p("n").alias("weight"))
    two = plain.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda k: F.col("w").substr(k, F.lit(2)))).alias("two"), "weight")
    pairs = np.ones((27, 27))
    for row in two.groupBy("two").agg(F.sum("weight").alias("weight")).collect():
        a, b = row["two"]
        pairs[_letter(a), _letter(b)] += row["weight"]
    return Lexicon(frozenset(r["w"] for r in top), -np.log2(pairs / pairs.sum(axis=1, keepdims=True)))


def _covered(value: str, words: frozenset[str]) -> float:
    """Share of the letters of ``value`` that words of the list cover, longest first from the left."""
    letters = sum(c.isalpha() for c in value)
    if not letters:
        return 0.0
    low, at, hit = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in words), 0)
        hit += size
        at += size or 1
    return min(1.0, hit / letters)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def feature_row(value: str, before: str, after: str, path: str, known: Lexicon) -> list[float]:
    """The figures named in :data:`FEATURES`; ``before`` and ``after`` are the text around, 60 characters will do."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    changes = [a != b for a, b in zip(kinds, kinds[1:], strict=False)]
    run = longest = 1
    for changed in changes:
        run = 1 if changed else run + 1
        longest = max(longest, run)
    letters = [_letter(c) for c in value.lower()]
    pairs = [known.surprise[a, b] for a, b in zip(letters, letters[1:], strict=False)]
    near = [w.lower() for w in _WORD.findall(before)[-3:]]
    follows = [w.lower() for w in _WORD.findall(after)[:2]]
    segments = [s for s in re.split(r"[/\\]", value) if s]
    count = Counter(kinds)
    return [
        float(n),
        count[0] / n,
        count[1] / n,
        count[2] / n,
        count[3] / n,
        len(set(value)) / n,
        sum(changes) / max(1, n - 1),
        longest / n,
        float(np.mean(pairs)) if pairs else 0.0,
        _covered(value, known.words),
        float(len(segments) > 2 or bool(re.match(r"\.[a-z]{2,4}\b", after))),
        float(bool(PATH_WORDS.search(path))),
        float(any(w in CREDENTIAL_WORDS for w in near) or bool(_URL_LEAD.search(before) and after.startswith("@"))),
        float(bool(re.search(r"[:=>]\s*[\"']?$", before))),
        float(any(w in HARMLESS_WORDS for w in near[-2:] + follows)),
        float(bool(re.search(r"(?i)x{4}|your|example|placeholder|dummy|sample|(.)\1{5}", value))),
    ]


def candidates(raw: np.ndarray, begin: int, end: int) -> list[tuple[int, int, str]]:
    """Byte ranges (start, end, kind) of one text, apart from each other and in order."""
    text = raw[begin:end]
    found: list[tuple[int, int, str]] = []
    inside = np.concatenate([[False], _RUN[text], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= RUN_CHARS
    digits = ragged.bounds(_DIGIT[text])
    for a, b in zip(starts[long], ends[long], strict=True):
        if digits[b] > digits[a]:
            found.append((int(a), int(b), "run"))
    marks = np.flatnonzero((text == 0x3D) | (text == 0x3A))
    data = text.tobytes()
    for at in marks.tolist():
        if _NAMED.search(data[max(0, at - 24) : at]) and (value := _VALUE.match(data, at + 1)):
            found.append((*value.span(1), "named"))
    if b"://" in data:
        found += [(*url.span(1), "url") for url in _IN_URL.finditer(data)]
    low = data.lower()
    if b"bearer" in low or b"basic" in low:
        found += [(*bearer.span(1), "bearer") for bearer in _BEARER.finditer(data)]
    if b"PRIVATE KEY-----" in data:
        found += [(*block.span(), "block") for block in _BLOCK.finditer(data)]
    # Keys first, then what a name or a place tells of, then by length; a range goes to the first that wants it.
    order = {"block": 0, "url": 1, "bearer": 2}
    found.sort(key=lambda s: (order.get(s[2], 3), s[0] - s[1], s[0]))
    taken = np.zeros(len(text) + 1, bool)
    apart: list[tuple[int, int, str]] = []
    for one in found:
        if not taken[one[0] : one[1]].any():
            taken[one[0] : one[1]] = True
            apart.append(one)
    return sorted(apart)


def example_findings(known: Lexicon, rows: int = LABELLED_ROWS, seed: int = SEED) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings (value, before, after, path, label) made up around words of the corpus, half of them secrets.

    For corpora that come without labelled findings of their own; their shapes are those of public key formats and of common harmless text.
    """
    draw = random.Random(seed)
    words = sorted(known.words)[:DICTIONARY_WORDS] or ["alpha", "beta", "gamma"]
    hexes, base64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def pick(letters: str, n: int) -> str:
        return "".join(draw.choice(letters) for _ in range(n))

    def prose(n: int) -> str:
        return " ".join(draw.choice(words) for _ in range(n))

    def secret() -> str:
        value = draw.choice([
            lambda: pick(hexes, draw.choice([32, 40, 40, 48, 64])),
            lambda: pick(base64, draw.randint(20, 48)),
            lambda: pick(base64 + "+/", draw.choice([40, 44, 64])) + draw.choice(["", "=", "=="]),
            lambda: "AKIA" + pick(base64[:26] + "0123456789", 16),
            lambda: draw.choice(["ghp_", "gho_", "sk-", "xoxb-", "glpat-"]) + pick(base64, draw.randint(20, 40)),
            lambda: pick(base64 + "!@#$%^&*", draw.randint(10, 18)),
        ])()
        return value.upper() if draw.random() < 0.15 else value

    def harmless() -> tuple[str, bool]:
        kind = draw.randrange(12)
        if kind == 0:
            return pick("0123456789", draw.choice([16, 16, 17, 18, 19, 20])), False
        if kind == 1:
            return draw.choice("-_").join([*(draw.choice(words) for _ in range(draw.randint(2, 5))), str(draw.randint(0, 9999))]), False
        if kind == 2:
            return "/".join([*(draw.choice(words) for _ in range(draw.randint(3, 6))), "v" + str(draw.randint(1, 20))]), False
        if kind == 3:
            return pick("=-_", 1) * draw.randint(16, 60) + str(draw.randint(0, 9)), False
        if kind == 4:
            return draw.choice(["xxxxxxxxxxxxxxxx1", "your_token_here_123", "EXAMPLEKEY1234567890", "placeholder-value-01", "dummy_password_0001", "0000000000000000"]), draw.random() < 0.7
        if kind == 5:
            return f"20{draw.randint(10, 29)}-{draw.randint(10, 12)}-{draw.randint(10, 28)}-{draw.choice(words)}-{draw.choice(words)}", False
        if kind == 6:
            return "".join(draw.choice(words) for _ in range(draw.randint(3, 6))) + str(draw.randint(0, 99)), False
        if kind == 7:
            return "".join(draw.choice(words) for _ in range(draw.randint(2, 4))).capitalize() + draw.choice(["!!", "2", ""]), True
        if kind == 8:
            # Addresses, with words and numbers in them.
            page = draw.choice(["_", "-", "/"]).join([draw.choice(words).capitalize() for _ in range(draw.randint(2, 5))] + [str(draw.randint(1, 2030))])
            return f"//{draw.choice(words)}.{draw.choice(['org', 'com', 'example.net'])}/{draw.choice(['wiki', 'en', 'blog', 'docs'])}/{page}", False
        return pick(hexes, draw.choice([32, 40, 40, 64, 64])), None

    out = []
    for k in range(rows):
        tail = " " + prose(2)
        path = draw.choice(["src/app", "conf/prod", "lib/core", "notes", "wiki", ""])
        if k % 2:
            if draw.random() < 0.85:
                name = draw.choice(["token", "secret", "password", "api_key", "access_key", "auth"])
                name = name.upper() if draw.random() < 0.2 else name
                lead = f'{prose(2)} {name}{draw.choice([" = ", "=", ": ", ":"])}{draw.choice([chr(34), chr(39), ""])}'
                if draw.random() < 0.15:
                    lead = f"{prose(2)} Authorization: {draw.choice(['Bearer', 'Basic', 'bearer'])} "
                elif draw.random() < 0.12:
                    lead = f"{prose(1)} {draw.choice(['postgres', 'https', 'redis', 'amqp'])}://{draw.choice(words)}:"
            else:
                lead = prose(3) + " "
            out.append((secret(), lead, ("@db.internal/x" if "://" in lead else draw.choice(['"', "'", ""])) + tail, path, 1))
        else:
            value, named = harmless()
            if named is None:
                lead = f"{prose(2)} {draw.choice(['commit', 'sha1', 'sha256', 'checksum', 'hash', 'md5', 'digest', 'etag', 'image'])}{draw.choice([' ', ': ', ':', ' = ', '='])}"
            elif named:
                lead = f'{prose(2)} {draw.choice(["token", "password", "secret"])} = "'
            else:
                lead = prose(3) + (" https:" if value.startswith("//") else draw.choice([" ", " ", " ", ": ", " id "]))
            out.append((value, lead, tail, draw.choice([path, "tests/data", "docs/example"]), 0))
    return out


@dataclass
class Forest:
    """Trees on end as arrays: feature (-1 at a leaf), threshold, the two branches; leaves hold their vote in ``threshold``."""

    roots: list[int]
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Share of trees that vote for a secret."""
        votes = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                value = rows[np.arange(len(rows)), np.maximum(self.feature[at], 0)]
                at = np.where(inner, np.where(value <= self.threshold[at], self.low[at], self.high[at]), at)
            votes += self.threshold[at]
        return votes / max(1, len(self.roots))


def train(spark: SparkSession, labelled: list[tuple[str, str, str, str, int]], known: Lexicon) -> Forest:
    """Fit Spark's random forest to labelled findings (value, before, after, path, label); at most ``LABELLED_ROWS`` of them."""
    rows = [([float(x) for x in feature_row(value, before, after, path, known)], float(label)) for value, before, after, path, label in labelled[:LABELLED_ROWS]]
    table = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").coalesce(1)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64).fit(table)
    return read_forest(model.toDebugString)


def read_forest(text: str) -> Forest:
    """The trees as Spark prints them."""
    feature, threshold, low, high, roots = [], [], [], [], []
    lines = [line.strip() for line in text.splitlines()]
    at = 0

    def node() -> int:
        nonlocal at
        here = len(feature)
        line = lines[at]
        feature.append(-1), threshold.append(0.0), low.append(0), high.append(0)
        if line.startswith("Predict:"):
            threshold[here] = float(line.split(":")[1])
            at += 1
            return here
        found = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        feature[here], threshold[here] = int(found[1]), float(found[2])
        at += 1
        low[here] = node()
        at += 1  # Else
        high[here] = node()
        return here

    while at < len(lines):
        if lines[at].startswith("Tree"):
            at += 1
            roots.append(node())
        else:
            at += 1
    return Forest(roots, np.array(feature), np.array(threshold), np.array(low), np.array(high))


def _judged(part: pa.RecordBatch, text_name: str, paths: list, forest: Forest, known: Lexicon) -> Iterator[tuple[int, list[tuple[int, int, str, float]]]]:
    """Per text with candidates: its number, and (start, end, kind, probability) by bytes."""
    raw, offsets = ragged.flat(part.column(text_name))
    for k in range(part.num_rows):
        begin, end = int(offsets[k]), int(offsets[k + 1])
        found = candidates(raw, begin, end)
        if not found:
            continue
        data = raw[begin:end].tobytes()
        # Of a block, each line of key characters is judged, and the likeliest counts.
        values, owner = [], []
        for n, (a, b, kind) in enumerate(found):
            body = _BLOCK.match(data, a).span("body") if kind == "block" else None
            inner = [run.span() for run in _KEY_RUN.finditer(data, *body)] if body else [(a, b)]
            lead, tail = (body[0], body[1]) if body else (a, b)
            before, after = data[max(0, lead - 120) : lead].decode(errors="ignore")[-60:], data[tail : tail + 120].decode(errors="ignore")[:60]
            values += [feature_row(data[c:d].decode(), before, after, paths[k] or "", known) for c, d in inner]
            owner += [n] * len(inner)
        chance = np.zeros(len(found))
        np.maximum.at(chance, owner, forest.predict(np.array(values)))
        yield k, [(a, b, kind, float(p)) for (a, b, kind), p in zip(found, chance, strict=True)]


def scan(docs: DataFrame, forest: Forest, known: Lexicon, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, start and length in code points, kind, value_sha256, probability, is_secret.

    Every whole text is read, in the tasks, without a shuffle; the forest and the word list are bounded and travel with the tasks.
    Kinds: ``run`` (16 or more key characters with a digit), ``named`` (8 or more after a credential's name), ``bearer`` (after the scheme of an authorisation
    header), ``url`` (the password in a URL), ``block`` (a private key: its header,
    the lines of key characters that follow, and an END line right after them; a header without such lines is none). NULL and empty text: no candidates. NULL path, or no such column: none. NULL doc_id: kept. Repeated rows: findings each. Empty table: no rows.
    """
    path = column(docs, path_col).cast("string") if path_col in docs.columns else F.lit("")
    narrow = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text"), path.alias("path"))
    kind_of_id = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "kind", "value_sha256", "probability", "is_secret"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                raw, offsets = ragged.flat(part.column("text"))
                chars, which, out = None, [], []
                for k, found in _judged(part, "text", part.column("path").to_pylist(), forest, known):
                    if chars is None:
                        chars = ragged.bounds((raw & 0xC0) != 0x80)
                    begin = int(offsets[k])
                    for a, b, kind, p in found:
                        at, end = chars[begin + a], chars[begin + b]
                        which.append(k)
                        out.append((int(at - chars[begin]), int(end - at), kind, hashlib.sha256(raw[begin + a : begin + b].tobytes()).hexdigest(), p, p >= threshold))
                if out:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(which)), *(pa.array(x) for x in zip(*out, strict=True))], names=names)

    return narrow.mapInArrow(run, f"doc_id {kind_of_id}, start bigint, length bigint, kind string, value_sha256 string, probability double, is_secret boolean")


def redact(docs: DataFrame, forest: Forest, known: Lexicon, threshold: float = THRESHOLD, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with every secret in the text replaced by :data:`MASK`; all rows and columns stay, ``n_chars`` follows a changed text if it is a whole number."""
    columns = docs.columns
    path_at = columns.index(path_col) if path_col in columns else None
    text_at = columns.index(text_col)
    size_at = columns.index("n_chars") if "n_chars" in columns and isinstance(docs.schema["n_chars"].dataType, T.IntegralType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, text_col):
                paths = part.column(path_at).cast(pa.string()).to_pylist() if path_at is not None else [None] * part.num_rows
                changed = {}
                for k, found in _judged(part, text_col, paths, forest, known):
                    data, out, last = part.column(text_at)[k].as_py().encode(), [], 0
                    for a, b, _, p in found:
                        if p >= threshold:
                            out += [data[last:a], MASK.encode()]
                            last = b
                    if out:
                        changed[k] = b"".join([*out, data[last:]]).decode()
                if changed:
                    arrays = list(part.columns)
                    kept = arrays[text_at].to_pylist()
                    arrays[text_at] = pa.array([changed.get(k, t) for k, t in enumerate(kept)], arrays[text_at].type)
                    if size_at is not None:
                        sizes = arrays[size_at].to_pylist()
                        arrays[size_at] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(sizes)], arrays[size_at].type)
                    part = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)


def trained(docs: DataFrame) -> tuple[Forest, Lexicon]:
    """Forest and lexicon for a corpus without labelled findings."""
    known = learn_lexicon(docs)
    return train(docs.sparkSession, example_findings(known), known), known
