"""Secret scans: token runs and named values are candidates, a random forest removes the false positives.

Candidates are, whatever their length where a name tells of them:

* every value after a telling name (``password``, ``dbPassword``, ``api_key``) and a separator, of any length and of any characters
  but white space and quotes; closing ``.,;`` of the sentence are not part of it. After a space alone, the name must be the
  telling word itself or end in it;
* every block of a private key, from its BEGIN line to its END line (or to its last line of key characters);
* without a name, a run of ``[A-Za-z0-9+/=_.~-]`` that is not just a word: of ``RUN`` characters with a digit, ``_``, an inner
  ``=`` or a capital after a small letter, or of ``LONG_RUN`` of any. Of ``name=value`` the value is the candidate.

The forest sees a candidate's length, character transitions, coverage by dictionary words, path
marks and the neighbouring words. It is trained from labelled findings (text, start, end, label); without any
of one's own, from findings made by rule with a fixed seed.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick
from ledgerspark.llm.bytescan import Chunk, chunks

_CLASS = np.zeros(256, bool)
_CLASS[[ord(c) for c in string.ascii_letters + string.digits + "+/=_.~-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER, _SMALL = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_SMALL[97:123] = True
RUN, LONG_RUN = 8, 20
CONTEXT = 48

#: Words beside which a value is likely a secret, and beside which it is not.
TELLING = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "bearer", "credential", "credentials", "private", "access")
HARMLESS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "id", "version", "build", "revision", "href", "src", "url", "file", "path", "image", "example", "sample", "phone", "date", "order", "isbn", "etag")
#: What stands after a telling name where no secret does.
_FILLERS = frozenset(("none", "null", "nil", "true", "false", "str", "string", "bool", "int", "text", "required", "optional", "yes", "no", "is", "was", "of", "to", "the", "a", "an", "in", "for", "and", "or", "not", "on", "with", "by", "are", "must", "can", "will", "bearer", "basic", "undefined", "empty", "changeme", "redacted", "hidden"))
#: Words whose letters count as dictionary coverage.
DICTIONARY = ("about", "access", "account", "admin", "agent", "and", "api", "app", "article", "assets", "auth", "base", "blog", "build", "change", "class", "client", "code", "com", "component", "config", "connect", "content", "context", "count", "create", "data", "date", "default", "demo", "dev", "doc", "docs", "download", "error", "event", "example", "export", "field", "file", "first", "foo", "for", "form", "format", "from", "function", "get", "handler", "header", "here", "home", "html", "http", "https", "image", "images", "import", "index", "info", "input", "int", "item", "json", "key", "last", "lib", "license", "line", "link", "list", "local", "log", "main", "manager", "max", "message", "method", "min", "model", "module", "name", "net", "new", "node", "number", "object", "org", "output", "page", "param", "password", "path", "placeholder", "plugin", "port", "post", "process", "product", "project", "public", "query", "release", "report", "request", "resource", "response", "result", "root", "sample", "script", "search", "secret", "section", "server", "service", "session", "set", "size", "source", "src", "start", "state", "static", "status", "string", "style", "system", "table", "temp", "test", "text", "the", "time", "title", "token", "tool", "type", "update", "upload", "url", "user", "util", "value", "version", "view", "web", "with", "word", "world", "www", "your")
_WORDS = re.compile("|".join(sorted(DICTIONARY, key=len, reverse=True)))
_NEAR = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_PLAIN = re.compile(r"[A-Za-z_.~-]{2,}")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_TOLD = re.compile(r"(?:^|_)(?:" + "|".join(TELLING) + r")s?\d*(?:_|$)|(?:password|passwd|pwd|secret|token|apikey|api_key|credential)s?\d*$")
_NAME = re.compile(("(?:" + "|".join(sorted(TELLING, key=len, reverse=True)) + ")([a-z0-9_-]*)").encode())
_VALUE = re.compile(rb"""["'`]?[\])]?[ \t]*(?:=>|[:=]=|[=:>])[ \t]*["'`]?([^\s"'`]+)""")
_SPACED_VALUE = re.compile(rb"""[ \t]+["'`]?([^\s"'`]+)""")
_KEY_BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----BEGIN).)*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----|(?:\s*\n[A-Za-z0-9+/=]{16,})*)", re.S)
_FILE = re.compile(r"\.[A-Za-z]{2,4}$")
_COMMON_PAIRS = frozenset(a + b for w in DICTIONARY for a, b in zip(w, w[1:], strict=False))


@dataclass(frozen=True)
class SecretsConfig:
    trees: int = 40
    depth: int = 9
    least_leaf: int = 4
    seed: int = 5
    threshold: float = 0.5
    made_findings: int = 3000


@dataclass
class Forest:
    """One array per tree field, trees stacked: split feature (-1 in leaves), cut, children, share of positives."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for f, c, a, b, s in zip(self.feature, self.cut, self.left, self.right, self.share, strict=True):
            at = np.zeros(len(x), np.int64)
            while (inner := f[at] >= 0).any():
                down = np.where(x[every, f[at]] <= c[at], a[at], b[at])
                at = np.where(inner, down, at)
            total += s[at]
        return total / len(self.feature)


def describe(value: str, before: str, after: str) -> list[float]:
    """Features of a candidate between the texts beside it."""
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    counts = [kinds.count(k) / n for k in "duls"]
    moves = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    letters = value.lower()
    pairs = [a + b for a, b in zip(letters, letters[1:], strict=False) if a.isalpha() and b.isalpha()]
    common = sum(p in _COMMON_PAIRS for p in pairs) / len(pairs) if pairs else 0.0
    spread = [letters.count(c) / n for c in set(letters)]
    entropy = -sum(p * math.log2(p) for p in spread)
    covered = sum(len(m) for m in _WORDS.findall(letters)) / n
    near = [w.lower() for w in _NEAR.findall(before)[-3:]]
    last = _NEAR.findall(before)[-1:]
    close = near[-1:] + [p for w in near[-1:] for p in w.split("_")]
    told = any(w in TELLING for w in close) or any(_TOLD.search(_CAMEL.sub("_", w).lower()) for w in last)
    ends = before.rstrip().rstrip("\"'").rstrip()
    return [
        float(n), *counts, moves, common, len(pairs) / n, entropy, entropy / math.log2(n + 1), covered,
        float(all(c in string.hexdigits for c in value)), float(value.count("/")), float(value.count(".")), float(value.count("-")), float(value.count("_")),
        float(_FILE.search(value) is not None), float(re.search(r"://|www\.|\.com|\.org", value) is not None or before.endswith(("/", "://", "\\"))),
        max((len(m) for m in _PLAIN.findall(value)), default=0) / n, float(len(set(value)) / n),
        float(told), float(told or any(w in TELLING for w in near)), float(any(w in HARMLESS for w in near)),
        float(ends.endswith(("=", ":"))), float(before[-1:] in "\"'" and bool(before)), float(after[:1] in "\"'" and bool(after)),
        float(value.startswith(("AKIA", "ghp_", "glpat-", "sk_", "xox", "eyJ", "AIza", "-----BEGIN"))), float(value[:1] in "$<{%" and value[-1:] in "})>s" or value[-1:] in ")]"), float(any(c in "(){}[]<>;" for c in value)), float(letters in _FILLERS or value.isdigit() and n < 4),
    ]


def made_findings(n: int, seed: int) -> list[tuple[str, int, int, int]]:
    """Labelled findings by rule: (text, start, end, label)."""
    rng = random.Random(seed)

    def chars(alphabet: str, k: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(k))

    def words(k: int, joint: str) -> str:
        return joint.join(rng.choice(DICTIONARY) for _ in range(k))

    def nonsense() -> str:
        return "".join(rng.choice("aeiou") + rng.choice("bdfglmnrst") for _ in range(rng.randint(2, 6)))

    hexes, alnum, mixed = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/_-"
    name = lambda: rng.choice(("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "auth_token", "access_key", "client_secret", "TOKEN", "PASSWORD", "SECRET_KEY"))
    join = lambda: rng.choice(("=", " = ", ": ", ":", " ", ' = "', "='", '": "'))
    secret = lambda: rng.choice((lambda: chars(hexes, rng.choice((16, 18, 20, 24, 32, 40, 64))), lambda: chars(hexes.upper(), rng.choice((24, 32, 40))), lambda: chars(alnum, rng.randint(14, 48)), lambda: chars(mixed, rng.randint(20, 60)), lambda: "AKIA" + chars(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + chars(alnum, 36), lambda: chars(alnum, rng.randint(12, 20)), lambda: rng.choice(("glpat-", "sk_live_", "xoxb-", "AIza", "eyJ")) + chars(mixed, rng.randint(20, 60)), lambda: f"-----BEGIN {rng.choice(('RSA ', 'EC ', 'OPENSSH ', ''))}PRIVATE KEY-----\n" + chars(mixed, 64) + "\n" + chars(mixed, 40) + "=\n-----END PRIVATE KEY-----"))()
    harmless = (
        lambda: ("see /" + words(2, "/") + "/", chars(hexes, 32) + rng.choice((".png", ".js", ".css"))),
        lambda: (rng.choice(("commit ", "sha1 ", "md5: ", "checksum = ", "sha256:", "etag: ", "digest ")), chars(hexes, rng.choice((32, 40, 64)))),
        lambda: (rng.choice(("uuid ", "id=", "guid: ", "order ")), "-".join(chars(hexes, k) for k in (8, 4, 4, 4, 12))),
        lambda: ("", words(rng.randint(2, 4), rng.choice(("_", "-", ".", "/"))) + str(rng.randint(1, 99))),
        lambda: ("https:", "//www." + words(2, ".") + ".com/" + words(2, "/") + "/" + str(rng.randint(1, 9999))),
        lambda: ("on ", f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}.{rng.randint(10, 59)}"),
        lambda: ("at ", ".".join(str(rng.randint(100, 255)) for _ in range(4))),
        lambda: ("call ", "-".join(chars(string.digits, k) for k in (3, 3, 4, 3))),
        lambda: ("version ", f"{rng.randint(0, 99)}.{rng.randint(0, 99)}.{rng.randint(0, 99)}-beta.{rng.randint(1, 99)}"),
        lambda: (name() + join(), rng.choice(("your_token_here_1", "xxxxxxxxxxxxxxxx", "changeme12345", "example_password1", "placeholder-key-0", "000000000000000", "********12345678"))),
        lambda: (nonsense() + " ", nonsense() + nonsense() + str(rng.randint(0, 99)) + nonsense()),
        lambda: (nonsense() + " ", nonsense() + "-" + nonsense() + "=" + nonsense()),
        lambda: ("", chars(string.digits, rng.randint(12, 20))),
        lambda: ("", rng.choice(("=", "-", "_", ".", "ab", "=-")) * rng.randint(8, 30) + "1"),
    )
    leet = str.maketrans("aeiost", "431057")
    title = lambda w: w[0].upper() + w[1:]
    harmless += (
        lambda: (nonsense() + " ", words(1, "") + "".join(title(words(1, "")) for _ in range(rng.randint(1, 4)))),
        lambda: (nonsense() + " ", nonsense() + "".join(title(nonsense()) for _ in range(rng.randint(1, 2)))),
        lambda: (nonsense() + " ", words(rng.randint(2, 5), rng.choice("_-/"))),
        lambda: (nonsense() + " ", "_".join(nonsense() for _ in range(rng.randint(2, 3)))),
        lambda: (nonsense() + " ", nonsense() + nonsense() + nonsense()),
        lambda: (nonsense() + " ", title(nonsense()) + str(rng.randint(1, 2030))),
        lambda: (nonsense() + " ", "-".join(nonsense() for _ in range(rng.randint(3, 5)))),
        lambda: (nonsense() + " ", chars(rng.choice((alnum, string.ascii_uppercase + string.digits, hexes)), rng.randint(8, 14))),
        lambda: (rng.choice(("https:", "see ")), "//" + nonsense() + ".com/" + "/".join(nonsense() for _ in range(rng.randint(1, 3))) + "/" + "-".join(words(1, "") for _ in range(rng.randint(2, 6)))),
        lambda: ("at ", f"{rng.randint(1, 28)}-{rng.randint(1, 12)}-{rng.randint(1990, 2030)}"),
        lambda: (rng.choice(("isbn ", "call ", "phone ", "tel: ")), "-".join(chars(string.digits, rng.randint(1, 5)) for _ in range(rng.randint(2, 5)))),
    )
    telling = lambda: name() if rng.random() < 0.6 else rng.choice(("key", "private_key", "access_token", "DB_PASSWORD", "db_pwd", "clientSecret", "userPassword", "apiKey", "credentials", "auth"))
    chosen = (
        lambda: nonsense() + str(rng.randint(1, 9999)),
        lambda: title(nonsense()).translate(leet) + chars(string.digits, rng.randint(1, 3)),
        lambda: title(nonsense()).translate(leet) + rng.choice("!@#$%^&*?") + str(rng.randint(1, 2030)),
        lambda: title(rng.choice(DICTIONARY)).replace("a", "@").replace("o", "0") + rng.choice("!@#$%^&*?") + chars(string.digits, rng.randint(2, 4)),
        lambda: chars(alnum + "!@#$%^&*?", rng.randint(6, 16)),
        lambda: chars(alnum, rng.randint(6, 11)),
        lambda: chars(string.ascii_letters, rng.randint(8, 40)),
        lambda: chars(string.ascii_lowercase, rng.randint(12, 32)),
        lambda: words(rng.randint(2, 4), "") + rng.choice(("", "", str(rng.randint(1, 999)))),
        lambda: nonsense() + nonsense() + rng.choice(("", "!", "99")),
        lambda: words(1, "") + rng.choice(("", nonsense())) + chars(string.digits, rng.randint(1, 4)) + rng.choice(("", "!", "#")),
        lambda: nonsense() + rng.choice("äöüßéèñç") + nonsense() + rng.choice("!@#$%^&*?1234567890"),
    )
    cased = lambda w: rng.choice((w, w, title(w), w.upper()))
    explicit = lambda: rng.choice(("=", " = ", ": ", ":", ' = "', "='", '": "', '" => "', ': "'))
    unlikely = (
        lambda: (telling() + explicit(), cased(rng.choice(sorted(_FILLERS)))),
        lambda: (telling() + explicit(), cased(rng.choice(DICTIONARY))),
        lambda: (telling() + explicit(), words(rng.randint(2, 3), rng.choice("._-")) + rng.choice(("", "()", "(self)", "[0]", "()."))),
        lambda: (telling() + explicit(), rng.choice(("${", "{{", "<", "$(", "%(", "{")) + cased(rng.choice((words(rng.randint(1, 2), "_"), words(1, "") + "_" + chars(string.ascii_lowercase, 4)))) + rng.choice(("}", "}}", ">", ")", ")s"))),
        lambda: (telling() + explicit(), chars(rng.choice(("*", "x", "X", "#")), rng.randint(3, 11))),
        lambda: (rng.choice(("key", "access", "auth", "token")) + explicit(), str(rng.randint(0, 99))),
        lambda: (rng.choice(("the key ", "access ", "private ", "a secret ", "its token ", "your password ", "each key ")), rng.choice((rng.choice(sorted(_FILLERS)), rng.choice(DICTIONARY), nonsense()))),
        lambda: ("Authorization: ", rng.choice(("Bearer", "Basic", "Token"))),
    )
    out = []
    for k in range(n):
        lead = " ".join(nonsense() for _ in range(3)) + " "
        if k % 2:
            value, start = secret(), lead + name() + join()
            if rng.random() < 0.1 or value.startswith("-----BEGIN"):
                start = lead
                if not value.startswith("-----BEGIN"):
                    value = rng.choice(("AKIA" + chars(string.ascii_uppercase + string.digits, 16), "ghp_" + chars(alnum, 36), "sk_live_" + chars(alnum, 24), "glpat-" + chars(alnum, 20)))
            elif rng.random() < 0.35:
                value, start = rng.choice(chosen)(), lead + (telling() + explicit() if rng.random() < 0.85 else rng.choice(("Bearer ", "password ", "pwd ", "token ")))
        else:
            mark, value = rng.choice(harmless if rng.random() < 0.65 else unlikely)()
            start = lead + mark
        out.append((start + value + rng.choice(("", '"', "'", " ")) + nonsense(), len(start), len(start) + len(value), k % 2))
    return out


def fit(findings: Sequence[tuple[str, int, int, int]] | None = None, config: SecretsConfig = SecretsConfig()) -> Forest:
    """Train the forest from labelled findings: (text, start, end, 1 if it is a secret)."""
    findings = made_findings(config.made_findings, config.seed) if findings is None else findings
    x = np.array([describe(t[a:b], t[max(0, a - CONTEXT) : a], t[b : b + 8]) for t, a, b, _ in findings])
    y = np.array([label for *_, label in findings], float)
    rng = np.random.default_rng(config.seed)
    grown = [_grow(x, y, rng.integers(0, len(x), len(x)), rng, config) for _ in range(config.trees)]
    size = max(len(t) for t in grown)
    stacked = np.array([t + [(-1, 0.0, 0, 0, 0.0)] * (size - len(t)) for t in grown])
    return Forest(*(stacked[:, :, k].astype(np.int64 if k in (0, 2, 3) else float) for k in range(5)))


def _grow(x: np.ndarray, y: np.ndarray, rows: np.ndarray, rng: np.random.Generator, config: SecretsConfig) -> list[tuple]:
    """A tree as a list of (feature, cut, left, right, share), the root first."""
    nodes: list[tuple] = [()]
    waiting = [(0, rows, 0)]
    tries = max(1, int(math.sqrt(x.shape[1])) + 1)
    while waiting:
        at, own, depth = waiting.pop()
        share, best = y[own].mean(), None
        if depth < config.depth and len(own) >= 2 * config.least_leaf and 0 < share < 1:
            for f in rng.permutation(x.shape[1])[:tries]:
                order = own[np.argsort(x[own, f], kind="stable")]
                values, hits = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(own) + 1)
                k = np.flatnonzero(values[:-1] < values[1:])
                k = k[(k + 1 >= config.least_leaf) & (len(own) - k - 1 >= config.least_leaf)]
                if not len(k):
                    continue
                a, na, nb = hits[k], n[k], len(own) - n[k]
                b = hits[-1] - a
                gini = a * (na - a) / na + b * (nb - b) / nb
                j = int(gini.argmin())
                if best is None or gini[j] < best[0]:
                    best = gini[j], int(f), (values[k[j]] + values[k[j] + 1]) / 2
        if best is None:
            nodes[at] = (-1, 0.0, 0, 0, share)
            continue
        _, f, cut = best
        side = x[own, f] <= cut
        nodes[at] = (f, cut, len(nodes), len(nodes) + 1, share)
        waiting += [(len(nodes), own[side], depth + 1), (len(nodes) + 1, own[~side], depth + 1)]
        nodes += [(), ()]
    return nodes


def candidates(chunk: Chunk) -> list[tuple[int, int, int]]:
    """(row, first byte, end byte within the row) of candidate values, in order, each once; two may overlap."""
    return sorted({*_runs(chunk), *_named_values(chunk), *_key_blocks(chunk)})


def _key_blocks(chunk: Chunk) -> list[tuple[int, int, int]]:
    """Blocks of private keys."""
    data = chunk.data.tobytes()
    if b"PRIVATE KEY" not in data:
        return []
    return [(row, *found.span()) for row in range(chunk.rows) for found in _KEY_BLOCK.finditer(data[chunk.bounds[row] : chunk.bounds[row + 1]])]


def _named_values(chunk: Chunk) -> list[tuple[int, int, int]]:
    """Every value after a telling name and a separator."""
    out = []
    data = chunk.data.tobytes()
    for row in range(chunk.rows):
        text = data[chunk.bounds[row] : chunk.bounds[row + 1]]
        for found in _NAME.finditer(text.lower()):
            value = _VALUE.match(text, found.end()) or (None if found[1] else _SPACED_VALUE.match(text, found.end()))
            if value:
                a = value.start(1)
                b = a + len(value[1].rstrip(b".,;"))
                if a < b:
                    out.append((row, a, b))
    return out


def _runs(chunk: Chunk) -> list[tuple[int, int, int]]:
    """Runs of token characters that are not just a word."""
    data = chunk.data
    flag = np.concatenate([[False], _CLASS[data], [False]])
    flag_change = np.flatnonzero(flag[1:] != flag[:-1])
    start, end = flag_change[::2], flag_change[1::2]
    inner = chunk.bounds[1:-1]
    if len(inner) and len(start):  # a run never crosses rows
        run = np.searchsorted(start, inner, "right") - 1
        crossing = inner[(run >= 0) & (inner > start[run]) & (inner < end[run])]
        start, end = np.sort(np.append(start, np.unique(crossing))), np.sort(np.append(end, np.unique(crossing)))
    enough = end - start >= RUN
    start, end = start[enough], end[enough]
    if not len(start):
        return []
    cased = np.zeros(len(data), bool)
    cased[1:] = _UPPER[data[1:]] & _SMALL[data[:-1]]
    telling = np.concatenate([[0], np.cumsum(_DIGIT[data] | (data == 0x5F) | cased)])
    equals = np.concatenate([[0], np.cumsum(data == 0x3D)])
    hot = (telling[end] > telling[start]) | (equals[end - 2] > equals[start + 1]) | (end - start >= LONG_RUN)
    out = []
    for a, b in zip(start[hot].tolist(), end[hot].tolist(), strict=True):
        row = int(np.searchsorted(chunk.bounds, a, "right")) - 1
        text = data[a:b].tobytes()
        cut = text.rstrip(b"=").rfind(b"=") + 1  # name=value
        lo, hi = a + cut, a + len(text.rstrip(b".-~/"))
        while lo < hi and data[lo] in b"./~-":
            lo += 1
        if hi - lo >= RUN:
            out.append((row, lo - int(chunk.bounds[row]), hi - int(chunk.bounds[row])))
    return out


def scan_secrets(docs: DataFrame, forest: Forest, config: SecretsConfig = SecretsConfig(), mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_candidates, n_findings long, best double, findings_sha256 string, findings, redacted string``.

    A finding is a candidate whose forest score is the threshold or more: first and end code point, score; those that overlap
    are one finding, from the first to the last code point of them and with the greatest score. ``best`` is
    the greatest score of a candidate (0 without), the digest is of all found values, a line each, in order;
    ``redacted`` is the text with each finding replaced by ``mark`` (null for a null text). Input columns of these names are
    replaced. Whole texts are scanned, a null one as empty; equal texts get equal values.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    fields = [T.StructField("n_candidates", T.LongType()), T.StructField("n_findings", T.LongType()), T.StructField("best", T.DoubleType()), T.StructField("findings_sha256", T.StringType()), T.StructField("findings", T.ArrayType(span)), T.StructField("redacted", T.StringType())]

    def compute(batch: pa.RecordBatch) -> list:
        column = pick(batch, text_col)
        n = len(column)
        count, hits, best = [0] * n, [0] * n, [0.0] * n
        spans: list[list[dict]] = [[] for _ in range(n)]
        found: list[list[str]] = [[] for _ in range(n)]
        redacted = column
        swaps: dict[int, str] = {}
        for chunk in chunks(column):
            own = candidates(chunk)
            if not own:
                continue
            seen, x = [], []
            for row, a, b in own:
                base = int(chunk.bounds[row])
                before = chunk.data[base + max(0, a - CONTEXT) : base + a].tobytes().decode(errors="ignore")
                after = chunk.data[base + b : min(base + b + 8, int(chunk.bounds[row + 1]))].tobytes().decode(errors="ignore")
                value = chunk.data[base + a : base + b].tobytes().decode()
                x.append(describe(value, before, after))
                seen.append((row + chunk.first, base, a, b))
            p = shared.value.predict(np.array(x))
            merged: list[list] = []
            for (row, base, a, b), score in zip(seen, p.tolist(), strict=True):
                count[row] += 1
                best[row] = max(best[row], score)
                if score >= config.threshold:
                    if merged and merged[-1][0] == row and a < merged[-1][3]:
                        merged[-1][3:] = max(b, merged[-1][3]), max(score, merged[-1][4])
                    else:
                        merged.append([row, base, a, b, score])
            for row, base, a, b, score in merged:
                start = len(chunk.data[base : base + a].tobytes().decode())
                value = chunk.data[base + a : base + b].tobytes().decode()
                hits[row] += 1
                spans[row].append({"start": start, "end": start + len(value), "p": score})
                found[row].append(value)
        for row in range(n):
            if spans[row]:
                text, parts, at = column[row].as_py(), [], 0
                for s in spans[row]:
                    parts += [text[at : s["start"]], mark]
                    at = s["end"]
                swaps[row] = "".join([*parts, text[at:]])
        if swaps:
            redacted = pa.array([swaps.get(k, v) for k, v in enumerate(column.to_pylist())], pa.string())
        digests = [hashlib.sha256("".join(f"{v}\n" for v in f).encode()).hexdigest() for f in found]
        return [count, hits, best, digests, spans, redacted]

    return append(docs, fields, compute)
