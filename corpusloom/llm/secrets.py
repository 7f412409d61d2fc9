"""Secret scans: candidate strings, judged by a random forest that removes false positives.

Candidates are long tokens with a digit, values assigned to secret-sounding names, and passwords in
addresses. Features are the candidate's length, its character classes and the transitions between
them, the surprise of its letter pairs under the whole corpus, how much of it the corpus' dictionary
covers, what its document's path looks like, and the neighbouring words. The forest is trained with
Spark's MLlib on labelled findings and then applied to the candidates, as a few arrays.

Labelled findings are made by one generator for each family of secrets and of what is taken for
them (``SECRETS``, ``HARMLESS_KINDS``), from words of the documents: at most ``LABELLED`` rows, a
documented bound. No feature and no rule over features has a part in the labels. Letter pairs and
the dictionary are taken over all documents.

Scale: passes over the text without exchanging it give word counts, letter pairs and candidates. The
dictionary is every word that occurs ``LEAST`` times, however many there are: pieces of candidates
meet it in a join. Redaction joins the documents with the spans of those that have any. The forest
(``TREES`` trees of depth ``DEPTH``) and the pair table (65,536 cells) are bounded and travel with the code.

Defined results: null or empty texts have no findings; a null path has no features; repeated rows
give their findings each; without documents there are no labelled findings, and nothing counts as a
secret; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._store import materialize

LABELLED = 6_000
#: A word of the dictionary occurs so often, and has so many letters.
LEAST, LETTERS = 3, (3, 24)
TREES, DEPTH, SEED = 32, 8, 7
THRESHOLD = 0.5
REDACTED = "[REDACTED]"

#: Names that announce a secret, words that announce something harmless, parts of test paths.
SECRET_NAMES = ("access_key", "access-key", "accesskey", "api_key", "api-key", "apikey", "auth", "authorization", "bearer", "credential", "passphrase", "passwd", "password", "private", "private_key", "pwd", "secret", "token")
HARMLESS = ("card", "certificate", "change", "checksum", "commit", "config", "digest", "example", "fingerprint", "hash", "image", "insert", "integrity", "isbn", "load", "md5", "order", "phone", "png", "public", "read", "revision", "sample", "sequence", "sha1", "sha256", "sha384", "ssh-rsa", "test", "uuid", "version", "your")
TEST_PATHS = ("doc", "example", "fixture", "mock", "sample", "test")

_TOKEN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
_NAMES = b"|".join(re.escape(n.encode()) for n in sorted(SECRET_NAMES, key=len, reverse=True))
_ASSIGNED = re.compile(rb"(?i)(?:" + _NAMES + rb")[\"']?[ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}[\"']?([^\s\"'<>,;]{8,})")
#: Whole values of several parts: encoded blocks between marks, and parts joined by full stops.
_BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]{1,40}-----\s{1,4}([A-Za-z0-9+/=]{16,}(?:\r?\n[A-Za-z0-9+/=]+)*)")
_PARTS = re.compile(rb"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,})(?![A-Za-z0-9_.-])")
#: The password in an address with a user.
_ADDRESS = re.compile(rb"[a-z][a-z0-9+.-]{1,20}://[^\s:/@\"']{1,64}:([^\s@/\"']{6,})@")
#: A name in front of a value, as in files of settings; padding at a token's end is no assignment.
_LEADING = re.compile(rb"[A-Za-z0-9_-]+=(?=[^=])")
_WORD = re.compile(rb"[A-Za-z0-9_-]+")
FEATURES = (
    "length", "digits", "uppers", "lowers", "symbols", "transitions", "entropy", "distinct", "hex", "surprise",
    "path_test", "path_depth", "path_length", "quoted", "assigned", "secret_name", "secret_near", "harmless_near", "harmless_in", "dictionary",
)


@dataclass(frozen=True)
class Knowledge:
    """What the features need to know of the whole corpus."""

    surprise: np.ndarray  # 256 x 256, bits
    words: DataFrame  # (word), distinct


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        data, _ = B.buffers(batch.column(0))
        for a in range(0, max(0, len(data) - 1), B.SLICE_BYTES):
            piece = data[a : a + B.SLICE_BYTES + 1].astype(np.int32)
            total += np.bincount((piece[:-1] << 8) | piece[1:], minlength=1 << 16)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["pair", "n"])


def learn_corpus(docs: DataFrame, text: str = "text") -> Knowledge:
    """Letter pairs and the dictionary of all documents."""
    rows = docs.select(text).mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.full(1 << 16, 0.5)
    for r in rows:
        counts[r.pair] += r.n
    table = counts.reshape(256, 256)
    surprise = -np.log2(table / table.sum(axis=1, keepdims=True))
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), "[^a-z]+")).alias("word")).where(F.length("word").between(*LETTERS))
    words = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).select("word"), "dictionary")
    return Knowledge(surprise.astype(np.float32), words)


def candidates(raw: bytes) -> list[tuple[int, int]]:
    """Spans of candidate secrets, in order, none twice."""
    assigned, last = [], 0
    for a, b in sorted(m.span(1) for found in (_ASSIGNED, _ADDRESS, _BLOCK, _PARTS) for m in found.finditer(raw)):
        if a >= last:
            assigned.append((a, b))
            last = b
    spans, k = list(assigned), 0
    for m in _TOKEN.finditer(raw):
        a, b = m.span()
        while k < len(assigned) and assigned[k][1] <= a:
            k += 1
        if k < len(assigned) and assigned[k][0] < b:  # the assigned value wins, without its name
            continue
        while lead := _LEADING.match(raw, a, b):
            a = lead.end()
        if b - a >= 16 and any(48 <= c <= 57 for c in raw[a:b]):
            spans.append((a, b))
    return sorted(spans)


def features(raw: bytes, start: int, end: int, path: str | None, surprise: np.ndarray) -> list[float]:
    """All of FEATURES but the dictionary's share."""
    value = np.frombuffer(raw[start:end], np.uint8)
    n = len(value)
    kind = np.select([(value >= 48) & (value <= 57), (value >= 65) & (value <= 90), (value >= 97) & (value <= 122)], [0, 1, 2], 3)
    share = np.bincount(kind, minlength=4) / n
    counts = np.unique(value, return_counts=True)[1]
    p = counts / n
    before, after = raw[max(0, start - 60) : start], raw[end : end + 40]
    near = [w.lower() for w in _WORD.findall(before)[-4:]]
    around = [*near, *(w.lower() for w in _WORD.findall(after)[:3])]
    lead = before.rstrip(b"\"' \t")
    name = near[-1].decode() if near else ""
    path = (path or "").lower()
    parts = re.split(rb"[^a-z0-9]+", raw[start:end].lower())
    return [
        float(n), *share.tolist(),
        float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        float(-(p * np.log2(p)).sum()),
        len(counts) / n,
        float(np.isin(value, np.frombuffer(b"0123456789abcdefABCDEF", np.uint8)).mean()),
        float(surprise[value[:-1], value[1:]].mean()) if n > 1 else 0.0,
        float(any(t in path for t in TEST_PATHS)), float(path.count("/")), float(len(path)),
        float(before[-1:] in (b'"', b"'") and after[:1] in (b'"', b"'")),
        float(lead[-1:] in (b"=", b":", b">")),
        float(any(s in name for s in SECRET_NAMES)),
        float(any(s in w.decode() for w in around for s in SECRET_NAMES)),
        float(any(h in w.decode() for w in around for h in HARMLESS)),
        float(any(h.encode() in parts for h in HARMLESS)),
    ]


_FOUND = "key string, tag long, start long, length long, value_sha256 string, low string, features array<double>"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, piece) -> (a, b, place, n, word): all parts of each piece that could be words, some places at a time."""
    least, most = LETTERS
    for batch in batches:
        for a, b, piece in zip(*(batch.column(c).to_pylist() for c in range(3))):
            last = len(piece) - least + 1
            for start in range(0, last, 1 << 12):
                where = [(i, n) for i in range(start, min(last, start + (1 << 12))) for n in range(least, min(most, len(piece) - i) + 1)]
                columns = [pa.repeat(pa.scalar(x, pa.int64()), len(where)) for x in (a, b)]
                columns += [pa.array([i + 1 for i, _ in where], pa.int32()), pa.array([n for _, n in where], pa.int32()), pa.array([piece[i : i + n] for i, n in where])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "place", "n", "word"])


def _found(docs: DataFrame, known: Knowledge, key: str, text: str, path: str) -> DataFrame:
    """(key, tag, start, length, value_sha256, features) of every candidate, with the dictionary's share joined to it; ``tag`` is the text's hash."""
    surprise = known.surprise
    narrow = docs.select(F.col(key).cast("string").alias("key"), F.xxhash64(text).alias("tag"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()))
        for batch in batches:
            keys, tags, paths = (batch.column(c).to_pylist() for c in range(3))
            data, offsets = B.buffers(batch.column(3))
            raw, rows = data.tobytes(), []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = raw[a:b]
                for start, end in candidates(own):
                    value = own[start:end]
                    rows.append((keys[i], tags[i], start, end - start, hashlib.sha256(value).hexdigest(), value.lower().decode("latin-1"), features(own, start, end, paths[i], surprise)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=[f.split()[0] for f in _FOUND.split(", ")])

    found = materialize(narrow.mapInArrow(run, _FOUND), "candidates")
    both = [F.xxhash64("piece").alias("a"), F.xxhash64(F.lit(1), "piece").alias("b")]
    pieces = found.select("low").distinct().select("low", F.explode(F.split("low", "[^a-z]+")).alias("piece")).where(F.length("piece") >= LETTERS[0]).select("low", "piece", *both)
    parts = pieces.select("a", "b", "piece").distinct().mapInArrow(_parts, "a long, b long, place int, n int, word string").join(known.words, "word", "left_semi")
    # the longest word from the left, then on behind it
    hits = F.sort_array(F.collect_list(F.struct("place", (-F.col("n")).alias("n"))))
    start = F.struct(F.lit(1).alias("next"), F.lit(0).alias("hit"))
    step = lambda acc, x: F.when(x["place"] >= acc["next"], F.struct((x["place"] - x["n"]).alias("next"), (acc["hit"] - x["n"]).alias("hit"))).otherwise(acc)
    covered = parts.groupBy("a", "b").agg(F.aggregate(hits, start, step, lambda acc: acc["hit"]).alias("hit"))
    shares = pieces.join(covered, ["a", "b"]).groupBy("low").agg((F.sum("hit") / F.length("low")).alias("share"))
    return found.join(shares, "low", "left").withColumn("features", F.concat("features", F.array(F.coalesce("share", F.lit(0.0))))).drop("low", "share")


# ------------------------------------------------------------------------------- labelled findings


class _Draw:
    """Choices that depend on a seed alone."""

    HEX, UPPER, LOWER, DIGITS = "0123456789abcdef", string.ascii_uppercase, string.ascii_lowercase, string.digits
    LONG, URL = UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "-_"

    def __init__(self, seed: str, words: list[str]) -> None:
        self.random, self.words = random.Random(seed), words or ["value", "other"]

    def of(self, letters: str, n: int, most: int = 0) -> str:
        return "".join(self.random.choices(letters, k=self.random.randint(n, max(n, most))))

    def one(self, *choices: str) -> str:
        return self.random.choice(choices)

    def word(self) -> str:
        return self.random.choice(self.words)

    def name(self) -> str:
        name = self.one(*SECRET_NAMES)
        return self.one(name, name.upper().replace("-", "_"), f"{self.word()}_{name}", f"{self.word()}_{name}".upper().replace("-", "_"))

    def set(self, name: str, value: str) -> tuple[str, str, str]:
        """(before, value, behind) in one of the ways to assign."""
        before, behind = self.one((f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""), (f'"{name}": "', '",'), (f"export {name}=", ""), (f"{name}: '", "'"), (f"{name} := \"", '"'))
        return before, value, behind


#: One generator for each family of secrets: (before, value, behind).
SECRETS = {
    "hex_token": lambda d: d.set(d.name(), d.of(d.HEX, 32, 64)),
    "password": lambda d: d.set(d.one("password", "passwd", "db_password", "DB_PWD"), d.of(d.LONG + "!$%&*+?^~", 9, 20) + d.of(d.DIGITS, 1)),
    "mixed_token": lambda d: d.set(d.name(), d.of(d.LONG, 20, 48)),
    "upper_hex_token": lambda d: d.set(d.name().upper(), d.of(d.HEX, 32, 40).upper()),
    "cloud_key_id": lambda d: d.one(d.set(d.one("AWS_ACCESS_KEY_ID", "aws_access_key_id", "accessKeyId"), "AKIA" + d.of(d.UPPER + "234567", 16)), (f"{d.word()} ", "AKIA" + d.of(d.UPPER + "234567", 12) + d.of("234567", 4), "")),
    "cloud_secret": lambda d: d.set(d.one("AWS_SECRET_ACCESS_KEY", "aws_secret_access_key", "secret"), d.of(d.LONG + "/+", 40)),
    "forge_token": lambda d: d.one((f"{d.word()} ", d.one("ghp_", "gho_", "ghs_", "glpat-") + d.of(d.LONG, 36), ""), d.set(d.one("GITHUB_TOKEN", "token"), "ghp_" + d.of(d.LONG, 36))),
    "chat_token": lambda d: d.one((f"{d.word()} ", f"xoxb-{d.of(d.DIGITS, 12)}-{d.of(d.DIGITS, 12)}-{d.of(d.LONG, 24)}", ""), d.set("slack_token", f"xoxp-{d.of(d.DIGITS, 11)}-{d.of(d.LONG, 24)}")),
    "signed_token": lambda d: (d.one("Authorization: Bearer ", "jwt ", f"{d.word()} "), f"eyJ{d.of(d.URL, 33)}1.eyJ{d.of(d.URL, 60, 120)}2.{d.of(d.URL, 43)}", ""),
    "private_key": lambda d: ("-----BEGIN " + d.one("RSA ", "EC ", "") + "PRIVATE KEY-----\n", "\n".join(d.of(d.LONG + "+/", 63) + d.of(d.DIGITS, 1) for _ in range(3)), "\n-----END"),
    "payment_key": lambda d: d.one((f"{d.word()} ", d.one("sk_live_", "rk_live_") + d.of(d.LONG, 24, 32), ""), d.set("STRIPE_API_KEY", "sk_live_" + d.of(d.LONG, 24))),
    "maps_key": lambda d: d.one((f"{d.word()}?key=", "AIza" + d.of(d.URL, 34) + "7", ""), d.set("api_key", "AIza" + d.of(d.URL, 35))),
    "package_token": lambda d: (d.one("//registry/:_authToken=", f"{d.word()} "), d.one("npm_", "pypi-") + d.of(d.LONG, 36), ""),
    "bearer": lambda d: (d.one("Authorization: Bearer ", "authorization: token ", "-H 'Authorization: Bearer "), d.of(d.LONG, 24, 40) + d.of(d.DIGITS, 1), ""),
    "address": lambda d: (f"{d.one('postgres', 'mysql', 'amqp', 'https')}://{d.word()}:", d.of(d.LONG, 10, 20) + d.of(d.DIGITS, 2), f"@{d.word()}/db"),
    "hex_header": lambda d: (d.one("X-Api-Key: ", "x-auth-token: ", "secret ", "client_secret "), d.of(d.HEX, 32, 48), ""),
    "one_time": lambda d: d.one(d.set(d.one("otp_secret", "totp_secret"), d.of(d.UPPER + "234567", 31) + "7"), ("otpauth://totp/app?secret=", d.of(d.UPPER + "234567", 31) + "7", "&digits=6")),
    "shop_token": lambda d: d.one((f"{d.word()} ", d.one("shpat_", "dckr_pat_", "sq0atp-", "dop_v1_") + d.of(d.HEX, 32), ""), d.set(d.name(), "shpat_" + d.of(d.HEX, 32))),
    "hook": lambda d: (f"https://hooks.{d.word()}.com/services/", f"T{d.of(d.UPPER + d.DIGITS, 9)}/B{d.of(d.UPPER + d.DIGITS, 9)}/{d.of(d.LONG, 23)}1", ""),
}
#: The same for what is easily taken for a secret.
HARMLESS_KINDS = {
    "digest": lambda d: d.one(d.set(d.one("sha1", "checksum", "digest", "md5"), d.of(d.HEX, 32, 64)), (f"{d.one('commit', 'revision', 'sha256', 'hash')} ", d.of(d.HEX, 40), "")),
    "upper_digest": lambda d: (d.one("SHA1: ", "MD5 ", "Fingerprint: "), d.of(d.HEX, 32, 40).upper(), ""),
    "uuid": lambda d: (d.one("uuid ", "id=", f"{d.word()} "), "-".join(d.of(d.HEX, n) for n in (8, 4, 4, 4, 12)), ""),
    "card": lambda d: (d.one("card ", f"{d.word()} "), d.one("4", "5", "6", "9") + d.of(d.DIGITS, 15), ""),
    "number": lambda d: d.one((d.one("order ", "phone ", "isbn ", f"{d.word()} "), d.of(d.DIGITS, 16, 24), ""), d.set(d.one("order", "order_id", "isbn"), d.of(d.DIGITS, 16, 20))),
    "slug": lambda d: (d.one("/", f"{d.word()} "), "-".join(d.word() for _ in range(5)) + "-" + d.of(d.DIGITS, 1, 4), ""),
    "placeholder": lambda d: d.set(d.name(), d.one("your", "my", "insert", "change") + d.one("-", "_") + d.one("api-key-here", "secret_token_here", "password-goes-here", "access_key_value") + d.of(d.DIGITS, 1)),
    "mask": lambda d: d.set(d.name(), d.one("x", "X", "*", "0", "a") * d.random.randint(12, 30) + d.of(d.DIGITS, 1)),
    "file_path": lambda d: (f"{d.word()} ", "/" + "/".join(d.word() for _ in range(5)) + "/v" + d.of(d.DIGITS, 1), ""),
    "identifier": lambda d: d.one((f"{d.word()} ", "".join(d.word().title() for _ in range(4)) + d.of(d.DIGITS, 1), "()"), (f"{d.word()} ", "_".join(d.word() for _ in range(4)) + d.of(d.DIGITS, 1), "")),
    "call": lambda d: d.set(d.name(), d.one("get", "read", "load", "config", "settings") + "_" + "_".join(d.word() for _ in range(2)) + "_" + d.one("token", "password", "secret", "key") + d.of(d.DIGITS, 0, 1)),
    "time": lambda d: (d.one("at ", f"{d.word()} "), f"20{d.of(d.DIGITS, 2)}-0{d.of('123456789', 1)}-1{d.of(d.DIGITS, 1)}T0{d.of(d.DIGITS, 1)}-{d.of(d.DIGITS, 2)}-{d.of(d.DIGITS, 2)}", ""),
    "image": lambda d: (d.one("data:image/png;base64,", "sample image "), "iVBORw0KGgo" + d.of(d.LONG + "+/", 80, 200) + "==", ""),
    "reference": lambda d: d.set(d.name(), d.one("${", "$(", "{{") + "_".join(d.word() for _ in range(3)).upper() + "_" + d.of(d.DIGITS, 1) + d.one("}", ")", "}}")),
    "asset": lambda d: (f"{d.word()}/app-version-", d.of(d.HEX, 20), d.one("-js", "-css")),
    "words": lambda d: d.set(d.name(), "_".join(d.word() for _ in range(4)) + d.of(d.DIGITS, 1)),
    "public_key": lambda d: (d.one("ssh-rsa ", "ssh-ed25519 "), "AAAAB3NzaC1yc2E" + d.of(d.LONG + "+/", 150, 250), " user"),
    "certificate": lambda d: ("-----BEGIN " + d.one("CERTIFICATE", "PUBLIC KEY") + "-----\n", "\n".join(d.of(d.LONG + "+/", 63) + d.of(d.DIGITS, 1) for _ in range(2)), "\n-----END"),
    "integrity": lambda d: (d.one('integrity="sha384-', 'hash "sha256-'), d.of(d.LONG + "+/", 63) + "7", '"'),
    "sequence": lambda d: d.set(d.name(), d.one("1234567890" * 2, "abcdefghijklmnop1", "0123456789abcdef", "deadbeef" * 4 + "0", "changeme" + d.of(d.DIGITS, 4), "12345678" + "0" * d.random.randint(4, 20))),
    "template": lambda d: d.set(d.name(), d.one("<", "[", "%") + "_".join(d.word() for _ in range(2)) + d.one("_token_", "_key_", "_") + d.of(d.DIGITS, 1) + d.one(">", "]", "%")),
}
FAMILIES = [*((n, 1, make) for n, make in SECRETS.items()), *((n, 0, make) for n, make in HARMLESS_KINDS.items())]
#: Where findings stand; examples stand in the second kind of place more often.
PATHS = (("config/settings.py", ".env", "deploy/prod/values.yaml", "src/app/main.go", "notes/log.txt"), ("docs/example.md", "tests/fixtures/data.json", "sample/config.ini"))


def made_findings(docs: DataFrame, most: int = LABELLED, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(key, text, path, start, length, family, label): at most ``most`` lines, from documents that a hash of their ids picks."""
    wanted, there = most // len(FAMILIES), docs.count()
    part = (1 << 20) if there <= wanted else max(1, int((1 << 20) * 0.8 * wanted / there))
    few = docs.where(F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1 << 20)) < part)
    few = few.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(path).cast("string").alias("path")).limit(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, said, where in zip(*(batch.column(c).to_pylist() for c in range(3))):
                words = [w for w in (said or "").lower().split() if w.isascii() and w.isalpha() and len(w) > 2]
                for family, label, make in FAMILIES:
                    d = _Draw(f"{doc_id}/{family}", words)
                    before, value, behind = make(d)
                    before = f"{d.word()} {d.word()}{d.one(' ', chr(10), '. ')}{before}"
                    line = f"{before}{value}{behind}{d.one(' ', chr(10))}{d.word()} {d.word()}"
                    likely = PATHS[d.random.random() < (0.1 if label else 0.35)]
                    rows.append((f"{doc_id}/{family}", line, d.one(*likely, where or ""), len(before.encode()), len(value.encode()), family, float(label)))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=["key", "text", "path", "at", "size", "family", "label"])

    return few.mapInArrow(run, "key string, text string, path string, at long, size long, family string, label double")


def labelled_findings(docs: DataFrame, known: Knowledge, most: int = LABELLED, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(family, features, label) of the candidates within the values of :func:`made_findings`."""
    made = materialize(made_findings(docs, most, key, text, path), "made-findings")
    inside = (F.col("start") < F.col("at") + F.col("size")) & (F.col("start") + F.col("length") > F.col("at"))
    return _found(made, known, "key", "text", "path").join(made.select("key", "at", "size", "family", "label"), "key").where(inside).select("family", "features", "label")


# ------------------------------------------------------------------------------------------ forest


@dataclass(frozen=True)
class Forest:
    """Trees as arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """The mean share of secrets in the leaves that each row reaches."""
        at = np.repeat(self.roots[None, :], len(rows), axis=0)
        line = np.arange(len(rows))[:, None]
        for _ in range(DEPTH + 1):
            at = np.where(rows[line, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at].mean(axis=1)


NOTHING = Forest(*(np.zeros(1, k) for k in (np.int64, np.int64, np.float64, np.int64, np.int64, np.float64)))


def train_forest(labelled: DataFrame) -> Forest:
    """Fit MLlib's random forest and take its trees as arrays."""
    rows = materialize(labelled.select(array_to_vector("features").alias("features"), "label"), "labelled-findings")
    if rows.select("label").distinct().count() < 2:
        return NOTHING
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)
    nodes: list[list[float]] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append([])
        if "Leaf" in node.getClass().getSimpleName():
            stats = list(node.impurityStats().stats())
            nodes[at] = [0, 0.0, at, at, stats[1] / sum(stats)]
        else:
            split = node.split()
            nodes[at] = [split.featureIndex(), split.threshold(), add(node.leftChild()), add(node.rightChild()), 0.0]
        return at

    roots = [add(tree.rootNode()) for tree in model._java_obj.trees()]
    columns = list(zip(*nodes))
    return Forest(np.array(roots), *(np.array(c, k) for c, k in zip(columns, (np.int64, np.float64, np.int64, np.int64, np.float64))))


# -------------------------------------------------------------------------------------------- scan


def _judged(docs: DataFrame, known: Knowledge, forest: Forest, key: str, text: str, path: str) -> DataFrame:
    """Candidates with their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
            score = forest.predict(rows) if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(5)), pa.array(score)], names=[*batch.schema.names[:5], "score"])

    found = _found(docs, known, key, text, path).select("key", "tag", "start", "length", "value_sha256", "features")
    return found.mapInArrow(run, "key string, tag long, start long, length long, value_sha256 string, score double")


def find_secrets(docs: DataFrame, known: Knowledge, forest: Forest, key: str = "doc_id", text: str = "text", path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """(key, start, length, value_sha256, score, is_secret) of every candidate; places are in bytes, the value itself isn't told."""
    out = _judged(docs, known, forest, key, text, path)
    return out.select(F.col("key").cast("long").alias(key), "start", "length", "value_sha256", "score", (F.col("score") > threshold).alias("is_secret"))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def redact_documents(docs: DataFrame, known: Knowledge, forest: Forest, key: str = "doc_id", text: str = "text", path: str = "source", length: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with every secret replaced by :data:`REDACTED`; ``length``, if present, follows the text."""
    where = docs.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None
    name, tag, spans = (_free(docs, n) for n in ("secret_key", "secret_tag", "secret_spans"))
    found = _judged(docs, known, forest, key, text, path).where(F.col("score") > threshold)
    found = found.groupBy(F.col("key").alias(name), F.col("tag").alias(tag)).agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias(spans))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, every = list(batch.columns[:-1]), batch.column(batch.num_columns - 1)
            changed = np.flatnonzero(np.asarray(every.is_valid()))
            if len(changed):
                texts, lists = columns[where].to_pylist(), every.to_pylist()
                sizes = columns[counted].to_pylist() if counted is not None else None
                for i in changed.tolist():
                    raw, out, last = texts[i].encode(), [], 0
                    for x in lists[i]:
                        out += [raw[last : x["start"]], REDACTED.encode()]
                        last = x["start"] + x["length"]
                    texts[i] = b"".join([*out, raw[last:]]).decode()
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                columns[where] = pa.array(texts, batch.schema.field(where).type)
                if sizes is not None:
                    columns[counted] = pa.array(sizes, batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    own = docs.select("*", F.col(key).cast("string").alias(name), F.xxhash64(text).alias(tag)).alias("d")
    same = F.col(f"d.{name}").eqNullSafe(F.col(f"s.{name}")) & (F.col(f"d.{tag}") == F.col(f"s.{tag}"))
    joined = own.join(found.alias("s"), same, "left").select(*(F.col(f"d.`{c}`") for c in docs.columns), F.col(f"s.{spans}"))
    return joined.mapInArrow(run, docs.schema)


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> tuple[Knowledge, Forest]:
    known = learn_corpus(docs, text)
    return known, train_forest(labelled_findings(docs, known, LABELLED, key, text, path))


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_secrets(docs, *learn(docs))
