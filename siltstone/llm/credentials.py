"""Credentials embedded in source code (problem 5): where they are, and the texts without them.

Candidates are runs of characters that look made up (letters with digits or marks among them, or letters whose case
changes too often for names), and whatever stands where a credential is given: behind `password =` and the like, or
behind a user name in a URL. Each is described by

* character Markov models, one of ordinary text and one of secrets: how much likelier the run is as a secret;
* its form (length, classes, hexadecimal, a UUID, a known token prefix, readable once decoded from base64), and, where
  it does not look made up, whether it is put together from words that many texts hold;
* the identifiers and marks around it in its line, and in the line before where that leads to it;
* the file's kind and the words of its path.

A logistic regression weighs all that. It is trained, with the Markov models, on all candidates of all files, which
patterns label: a value behind `password =`, in a URL behind a user name, with a provider's prefix is a secret; a
checksum, a UUID, an entity tag, an ordinary word is none. Its scores are then calibrated (Platt) on labelled candidates
that were held out. The patterns only teach: what is found is decided by the calibrated score, so that secrets in places
no pattern names are found, and look-alikes in such places are not.

Candidates stay in partitions. In each pass every partition sums up what its candidates say, the sums, each of the
model's size, are added up, and one step is taken for all.
"""

from __future__ import annotations

import base64
import binascii
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import cut, drop, ship

#: Hashed features of the regression, its passes and steps, and the calibrated score from which a line holds a secret:
#: one that is missed counts for about six that are none.
FEATURES, PASSES, STEP, DECAY, SURE = 1 << 15, 60, 0.15, 2e-5, 0.15
#: One in so many values is held out for the calibration, and labelled ones of either kind that it needs at least.
HELD_OUT, FEWEST_HELD = 5, 20
#: Bits of the filter of ordinary words, and candidates whose scores a worker remembers before it forgets all of them.
WORD_BITS, KNOWN_SCORES = 1 << 23, 1 << 17

_ENDS = re.compile(r"\r\n|\r|\n")
_RUN = re.compile(r"[A-Za-z0-9!#$%^&*+~._-]{6,}")
#: What stands before a value where a credential is given, whatever it looks like.
_GIVES = re.compile(
    r"""(?i)(?:passw(?:or)?d|pwd|passphrase|secret|api[_-]?key|access[_-]?key|token|credential)["']?[ \t]*(?::=|=>|==|[:=])[ \t]*["'`]?\Z"""
    r"""|://[^\s:/@"'`]+:\Z"""
)
_SUBWORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*?)-----")
_KEY_LINE = re.compile(r"[ \t]*[\"'`]?(?:(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n]*|(?:[A-Za-z0-9+/=]|\\[nr])*+)[\"'`]?[ \t]*[+\\,;)]*[ \t]*(?:\r\n|\r|\n|\Z)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{8,}={0,2}(?![A-Za-z0-9+/=_-])")
_PARTS_BEFORE = re.compile(r"[A-Za-z0-9+/]*$")
_LETTERS = re.compile(r"[A-Za-z]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HEX = re.compile(r"[0-9a-fA-F]+")
_DIGIT = re.compile(r"[0-9]")
_MARKS = frozenset("!#$%^&*+~")
#: What ends the name of something given: `:`, `=` or `=>`.
_GIVING = frozenset(":=>")
_WORDS_NUMBER = re.compile(r"[a-z]+(?:[-_][a-z]+)*[-_]?\d{1,3}")

# Beginnings that providers give their tokens, and words that announce a secret or something else.
_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "xoxa-", "xoxs-", "sk_live_", "rk_live_", "sk_test_", "pk1.", "AIza", "AKIA", "ASIA", "SG.", "npm_", "eyJ")
_CUES = frozenset("password passwd pwd passphrase pass pw pin secret token apikey key bearer basic auth authorization credential credentials cred login signing sshpass".split())
_CALM = frozenset("sha256 sha512 sha1 md5 sum checksum digest integrity etag commit checkout uuid trace image icon png hash public certificate username user email id idempotency rsa version revision fixed cherry picked bump latest".split())

_PLACEHOLDERS = "changeme change me required optional placeholder example sample dummy todo fixme none null nil true false undefined redacted masked hidden removed your here value string default test xxx xxxx xxxxx xxxxxx xxxxxxxx password passwd secret token".split()

# what teaches: a value in the group `v`
_TEACH_SECRET = [
    re.compile(r"""(?i)(?:password|passwd|\bpwd|passphrase|_pwd|_pass|\bpass|\bpw|secret|api[_-]?key|apikey|access[_-]?key|[_.-]token|\btoken|authtoken|x-auth-token|credential)["']?\s*(?::=|=>|==|[:=])\s*(?:\{\s*)?["'`]?(?P<v>[^\s"'`<>{}$,;)]{6,})"""),
    re.compile(r"""(?i)os\.Setenv\("\w*(?:TOKEN|PASS|PWD|SECRET|KEY)\w*",\s*"(?P<v>[^"\s$<>]{6,})"\)"""),
    re.compile(r"""[a-z][a-z0-9+.-]*://[^\s:/@"'`]*:(?P<v>[^\s:/@"'`<>{}$*]{6,})@"""),
    re.compile(r"""(?i)\b(?:bearer|basic)\s+(?P<v>[A-Za-z0-9+/=._-]{12,})"""),
    re.compile(r"""(?i)BasicAuth\("[^"]*",\s*"(?P<v>[^"]{6,})"\)"""),
    re.compile(r"""(?i)\b(?:password|passphrase|api key|token)\s+(?:is\s+)?[`'"]?(?P<v>(?=[^\s`'"]*\d)(?=[^\s`'"]*[A-Za-z])[^\s`'",;]{8,})"""),
    re.compile(r"""\s-(?:u\s+[^\s:"']+:|p\s+['"])(?P<v>[^\s'"$<>]{6,})"""),
    re.compile(r"""(?i)(?:sign(?:ing)?|hmac|webhook)\w*\s*(?::=|=)\s*(?:\[\]byte\()?["'`](?P<v>[^"'`\s]{16,})["'`]"""),
    re.compile(r"hooks\.[\w.-]+/services/\w+/\w+/(?P<v>\w{16,})"),
    re.compile(r"""(?i)(?:password|secret|token|api_?key)\w*\s*\)\s*VALUES\s*\('[^']*',\s*'(?P<v>[^'\s]{8,})'"""),
    re.compile(r"""(?P<v>(?:ghp_|gho_|github_pat_|glpat-|xox[abps]-|[sr]k_(?:live|test)_|AIza|AKIA|pk1\.)[A-Za-z0-9_.-]{6,})"""),
]
_TEACH_OTHER = [
    re.compile(r"(?P<v>[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"),
    re.compile(r"(?:sha(?:1|256|384|512)[:-]|h1:|;base64,)(?P<v>[A-Za-z0-9+/=]{16,})"),
    re.compile(r"(?i)(?:etag|checksum|digest|checkout|commit|revision|md5|idempotency_key|sha\d*)\W{1,6}(?:from commit )?(?P<v>[0-9a-f]{7,64})\b"),
    re.compile(r"(?P<v>[0-9a-f]{64})\s+[\w./-]+"),
    re.compile(r"(?i)(?:etag\b.*?VALUES\s*\(\s*')(?P<v>[0-9a-f]{16,64})'"),
    re.compile(r"(?i)(?<![/\w])user(?:name)?\s*[:=]\s*[\"']?(?P<v>[A-Za-z0-9+/=_-]{6,})"),
    re.compile(r"(?i)image\S*\s+(?P<v>sha256:\w+|[0-9a-f]{40,})"),
    re.compile(r"[?&]key_id=(?P<v>\w{6,})"),
    re.compile(r"(?i)\b(?:to|in|from|at|commit)\s+(?P<v>[0-9a-f]{7,12}|[0-9a-f]{40})\b"),
]


def made_up(run: str) -> bool:
    """Whether a run of characters may be a secret by its look."""
    if len(run) < 7 and not run.startswith(_PREFIXES):
        return False
    # words and names, as most runs are
    if run.isalpha():
        return not run.islower() and len(run) >= 8 and len(_SUBWORD.findall(run)) * 4 > len(run)
    letters, digits = sum(map(str.isalpha, run)), _DIGIT.search(run) is not None
    if letters < 2:
        return digits and not _MARKS.isdisjoint(run)
    if digits or not _MARKS.isdisjoint(run.strip("!#$%^&*+~.")):
        return True
    # a change of case every few letters
    return letters >= 8 and len(_SUBWORD.findall(run)) * 4 > letters


@dataclass
class Candidate:
    """A run at [start, end) of its text, in line `line` from 1; `counts_at` is where the secret would begin.

    `plain` is one that does not look made up, and is a candidate for its place only.
    """

    start: int
    end: int
    line: int
    counts_at: int
    value: str
    before: str
    after: str
    above: str
    plain: bool = False


@dataclass(frozen=True)
class Where:
    """What is told by the place of a text: the kind of file (its suffix, or `message`) and the words of its path."""

    kind: str
    words: tuple[str, ...] = ()


def where(path: str | None) -> Where:
    """The place of a file's content."""
    folder, _, name = (path or "").rpartition("/")
    suffix = name.rpartition(".")[2].lower() if "." in name else ""
    return Where(suffix, tuple(dict.fromkeys(subwords(name.rpartition(".")[0] if suffix else name) + subwords(folder)[-6:])))


MESSAGE = Where("message")


def _lines(text: str) -> tuple[list[int], list[int]]:
    """(where each line starts, where its content ends)."""
    starts, stops = [0], []
    for m in _ENDS.finditer(text):
        stops.append(m.start())
        starts.append(m.end())
    return starts, [*stops, len(text)]


def key_blocks(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, private) of each block between BEGIN and END lines.

    One without an END before the next BEGIN ends before the first line that is no base64, header or blank.
    """
    out = []
    at = 0
    while m := _BEGIN.search(text, at):
        stop = text.find("-----END ", m.end())
        after = _BEGIN.search(text, m.end())
        if stop < 0 or after and after.start() < stop:
            stop = m.end()
            while stop < len(text) and (line := _KEY_LINE.match(text, stop)):
                stop = line.end()
        out.append((m.end(), stop, "PRIVATE KEY" in m[1]))
        at = stop
    return out


def candidates(text: str) -> list[Candidate]:
    """The candidates of `text` outside of key blocks."""
    runs = []
    for m in _RUN.finditer(text):
        if made_up(m[0]):
            runs.append((m.start(), m.end(), False))
        elif (a := m.start()) and text[a - 1] in "\"'`=: \t>" and text[max(a - 4, 0) : a].rstrip("\"'` \t")[-1:] in _GIVING and _GIVES.search(text, max(a - 60, 0), a) and any(map(str.isalnum, m[0])):
            runs.append((m.start(), m.end(), True))
    if not runs:
        return []
    starts, stops = _lines(text)
    blocks = key_blocks(text) if "-----BEGIN " in text else []
    firsts: dict[int, int] = {}
    out = []
    for a, b, plain in runs:
        if any(lo <= a < hi for lo, hi, _ in blocks):
            continue
        n = bisect_right(starts, a)
        lo, hi = starts[n - 1], stops[n - 1]
        above = text[starts[n - 2] : stops[n - 2]].rstrip() if n > 1 else ""
        # a string put together over lines begins where its first part is
        first = n
        if above.endswith(("+", "\\", '" .')) and text[lo:a].strip() in ('"', "'", "`", ""):
            first = firsts.get(n - 1, n - 1)
        firsts[n] = first
        if first != n:
            above = text[starts[first - 1] : stops[first - 1]]
        out.append(Candidate(a, b, n, first, text[a:b], text[max(lo, a - 120) : a], text[b : min(hi, b + 60)], above[-120:], plain))
    return out


# --- Markov models ---------------------------------------------------------------------------------------------------

# classes of characters: letters, digits as one, the rest as one, and the edge
_CLASS = np.full(256, 28, np.int64)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _CLASS[ord(_c)] = _CLASS[ord(_c.upper())] = _i
_CLASS[[ord(c) for c in "0123456789"]] = 26
_EDGE, _SIZE = 27, 29
_CLASSES = _CLASS.tolist()


def _codes(word: str) -> np.ndarray:
    return np.concatenate([[_EDGE, _EDGE], _CLASS[np.frombuffer(word.encode("latin-1", "replace"), np.uint8)], [_EDGE]])


def count_trigrams(words: list[str]) -> np.ndarray:
    """Trigrams of `words`, each word once a time it is given; counts of parts of a list add up to those of all."""
    if not words:
        return np.zeros(_SIZE**3, np.int64)
    codes = np.concatenate([[_EDGE], *(_codes(w) for w in words)])
    three = (codes[:-2] * _SIZE + codes[1:-1]) * _SIZE + codes[2:]
    return np.bincount(three[~((codes[1:-1] == _EDGE) & (codes[:-2] != _EDGE))], minlength=_SIZE**3)


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two) for each trigram, smoothed by the frequency of the third."""
    table = counts.reshape(_SIZE * _SIZE, _SIZE).astype(float)
    base = (table.sum(0) + 1) / (table.sum() + _SIZE)
    return np.log((table + 3 * base) / (table.sum(1, keepdims=True) + 3)).ravel()


def _gain(word: str, models: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(mean over the word of how much likelier it is as a secret, mean log likelihood as ordinary text)."""
    ordinary, strange = memoryview(models[0]), memoryview(models[1])
    codes = [_CLASSES[x] for x in word.encode("latin-1", "replace")]
    pair, plain, secret = _EDGE * _SIZE + _EDGE, 0.0, 0.0
    for code in (*codes, _EDGE):
        three = pair * _SIZE + code
        plain += ordinary[three]
        secret += strange[three]
        pair = three % (_SIZE * _SIZE)
    n = len(codes) + 1
    return (secret - plain) / n, plain / n


def markov(value: str, models: tuple[np.ndarray, np.ndarray]) -> tuple[float, float, float]:
    """(mean gain over the letters, over the words of a name, mean log likelihood as ordinary text) of a value.

    Digits tell by the form, not here. Without letters all are 0.
    """
    runs = [w.lower() for w in _LETTERS.findall(value)]
    words = [w.lower() for w in _SUBWORD.findall(value) if not w[0].isdigit()]
    if not runs or not words:
        return 0.0, 0.0, 0.0
    long = [w for w in words if len(w) >= 3] or [max(words, key=len)]
    named = sum(len(w) * _gain(w, models)[0] for w in long) / sum(map(len, long))
    told = [(len(r), *_gain(r, models)) for r in runs]
    total = sum(n for n, _, _ in told)
    return sum(n * g for n, g, _ in told) / total, named, sum(n * x for n, _, x in told) / total


# --- features --------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1 << 17)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def _word_bit(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BITS


def subwords(text: str) -> list[str]:
    return [w.lower() for w in _SUBWORD.findall(text)]


class Words:
    """A filter of ordinary words: it has all that were put in, and few others."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(WORD_BITS // 8, np.uint8) if bits is None else bits

    def add(self, words: Iterable[str]) -> None:
        for w in words:
            n = _word_bit(w)
            self.bits[n >> 3] |= 1 << (n & 7)

    def __contains__(self, word: str) -> bool:
        n = _word_bit(word)
        return bool(self.bits[n >> 3] >> (n & 7) & 1)

    def spell(self, value: str) -> bool:
        """Whether a value is put together from ordinary words; without any letters it is not."""
        parts = [w for w in subwords(value) if not w[0].isdigit()]
        return bool(parts) and all(len(w) < 3 or w in self for w in parts)


def decoded(c: Candidate) -> str | None:
    """What the base64 text around a candidate says, if it is readable."""
    line = c.before + c.value + c.after
    at = len(c.before)
    for m in _BASE64.finditer(line):
        if m.start() <= at < m.end():
            text = m[0]
            if len(text) % 4 or not any(x.islower() for x in text) or text.islower():
                return None
            try:
                said = base64.b64decode(text, validate=True).decode("ascii")
            except (binascii.Error, UnicodeDecodeError):
                return None
            return said if said.isprintable() and len(said) >= 4 else None
    return None


def _form(value: str) -> str:
    if _UUID.fullmatch(value):
        return "uuid"
    if value.startswith(_PREFIXES):
        return "prefix"
    if _HEX.fullmatch(value):
        return "hex"
    if _WORDS_NUMBER.fullmatch(value):
        return "words-number"
    kinds = (any(x.islower() for x in value), any(x.isupper() for x in value), any(x.isdigit() for x in value), any(x in "!#$%^&*+~" for x in value), any(x in "-_." for x in value))
    return "".join("lUdms"[i] for i, k in enumerate(kinds) if k)


#: Features that are numbers; all others are there or not.
_NUMBERS = np.array([_slot(n) for n in ("gain", "most", "plain", "parts", "comment")])


def describe(c: Candidate, at: Where, models: tuple[np.ndarray, np.ndarray], ordinary: Words) -> tuple[list[int], list[float]]:
    """The features of a candidate of a text at `at`: those that are there, and the values of `_NUMBERS`."""
    kind = at.kind
    said = decoded(c)
    value = said if said else c.value
    secret = value.rpartition(":")[2] if said else value
    ids = [_slot("bias")]

    def add(name: str) -> None:
        ids.append(_slot(name))

    form = _form(secret) + ("/b64:" if said and ":" in said else "/b64" if said else "")
    if c.plain:
        add("plain look, ordinary words" if ordinary.spell(c.value) else "plain look, other words")
    gain, most, plain = markov(secret, models)
    numbers = [min(max(x, -3.0), 3.0) for x in (gain, most, plain + 2.5)]
    numbers += [min(len(_SUBWORD.findall(secret)), 12) / 12, float(c.before.lstrip().startswith(("#", "//", "--", "*")))]
    for limit in (-1.5, -1.0, -0.5, 0.0, 0.5, 1.0):
        if gain > limit:
            add(f"gain>{limit}")
        if most > limit:
            add(f"most>{limit}")
    add(f"form {form}")
    add(f"length {min(len(value) // 4, 16)}")
    # behind a slash, what is before the whole run of parts leads to it
    lead_in = _PARTS_BEFORE.sub("", c.before) if c.before.endswith("/") else c.before
    left, right = subwords(lead_in), subwords(c.after)
    near = left[-4:]
    tight = re.sub(r"[A-Za-z0-9]+", "w", c.before[-4:]) + "|" + re.sub(r"[A-Za-z0-9]+", "w", c.after[:3])
    add(f"tight {tight}")
    add(f"tight {tight} {form}")
    for w in set(left[-10:]):
        add(f"left {w}")
    for i, w in enumerate(reversed(near)):
        add(f"left{i} {w}")
        if i == 0:
            add(f"left0 {w} {form}")
    for w in set(right[:4]):
        add(f"right {w}")
    lead = c.counts_at != c.line or not near
    if lead:
        for w in set(subwords(c.above)[-8:]):
            add(f"above {w}")
    around = set(left[-10:]) | set(right[:4]) | (set(subwords(c.above)) if lead else set())
    cue, calm = bool(set(near) & _CUES), bool(around & _CALM)
    add(f"cue {cue} {calm}")
    add(f"cue {cue} {calm} {form}")
    for w in at.words:
        add(f"path {w}")
    add(f"kind {kind}")
    add(f"kind {kind} {form}")
    if "." in c.before[-2:] or "(" in c.after[:1]:
        add("member or call")
    return ids, numbers


def teach(line: str) -> list[tuple[int, int, int]]:
    """(start, end, 1 for a secret or 0) that the patterns say of parts of a line."""
    out = []
    for label, patterns in ((0, _TEACH_OTHER), (1, _TEACH_SECRET)):
        for p in patterns:
            for m in p.finditer(line):
                out.append((*m.span("v"), label))
    return out


# --- training --------------------------------------------------------------------------------------------------------

_ORDINARY = re.compile(r"[A-Z]?[a-z]{2,}")
#: An ordinary word is in so many texts; a candidate whose words all look so ordinary is no secret.
COMMON, ORDINARY_GAIN, STRANGE = 3, -0.7, -2.6


@dataclass
class Model:
    """The Markov models (ordinary, secret), the regression's weights, its calibration and the ordinary words."""

    markov: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray
    words: Words
    scale: float = 1.0
    shift: float = 0.0
    sure: float = SURE

    def save(self, path: str) -> None:
        """Keep the model in one file, for `load`."""
        np.savez(path, plain=self.markov[0], secret=self.markov[1], weights=self.weights, words=self.words.bits, platt=np.array([self.scale, self.shift, self.sure]))

    @classmethod
    def load(cls, path: str) -> Model:
        with np.load(path) as kept:
            return cls((kept["plain"], kept["secret"]), kept["weights"], Words(kept["words"]), *map(float, kept["platt"]))

    def margin(self, c: Candidate, at: Where) -> float:
        """The regression's log odds, before the calibration."""
        ids, numbers = describe(c, at, self.markov, self.words)
        return float(self.weights[ids].sum() + self.weights[_NUMBERS] @ numbers)

    def score(self, found: list[Candidate], at: Where) -> np.ndarray:
        """The calibrated probability of each candidate to be a secret."""
        known = self.__dict__.setdefault("_known", {})
        if len(known) > KNOWN_SCORES:
            known.clear()
        out = np.empty(len(found))
        for i, c in enumerate(found):
            # a line recurs in other versions of its file
            key = (at, c.before, c.value, c.after, c.above, c.counts_at != c.line, c.plain)
            m = known.get(key)
            if m is None:
                m = known[key] = self.margin(c, at)
            out[i] = m
        return self.likely(out)

    def likely(self, margin: np.ndarray) -> np.ndarray:
        """The calibrated probabilities of margins."""
        return 1 / (1 + np.exp(-(self.scale * margin + self.shift)))


def _secret_of(c: Candidate) -> str:
    said = decoded(c)
    return said.rpartition(":")[2] if said else c.value


def _platt_sums(margin: np.ndarray, label: np.ndarray, theta: np.ndarray, yes: int, no: int) -> np.ndarray:
    """What candidates add to the gradient (two) and to the second derivatives (three) of the calibration."""
    wanted = np.where(label == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    p = 1 / (1 + np.exp(-np.clip(theta[0] * margin + theta[1], -35, 35)))
    off, w = p - wanted, p * (1 - p)
    return np.array([(margin * off).sum(), off.sum(), (w * margin * margin).sum(), (w * margin).sum(), w.sum()])


def _calibrate(sums: Callable[[np.ndarray], np.ndarray], yes: int, no: int) -> tuple[float, float]:
    """(scale, shift) by Newton's method, from what all candidates add up to at a (scale, shift)."""
    if min(yes, no) < FEWEST_HELD:
        return 1.0, 0.0
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        g0, g1, h00, h01, h11 = sums(theta)
        step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-6 * np.eye(2), np.array([g0, g1]))
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(scale, shift) under which the margins of held-out candidates are log odds, by Newton's method.

    Without FEWEST_HELD candidates of either kind there is nothing to calibrate by: then (1, 0).
    """
    yes, no = int((label == 1).sum()), int((label == 0).sum())
    return _calibrate(lambda theta: _platt_sums(margin, label, theta, yes, no), yes, no)


def _label(c: Candidate, y: int, models: tuple[np.ndarray, np.ndarray], words: Words) -> int:
    """What a candidate teaches, 1, 0 or -1 for nothing: what the patterns say, but ordinary words are no secret."""
    if c.plain:
        return 0 if y == 0 or words.spell(c.value) else y
    if y != 0 and _form(c.value) not in ("hex", "uuid", "prefix"):
        gain, most, _ = markov(_secret_of(c), models)
        if gain < 0 and most < ORDINARY_GAIN:
            return 0
    return y


def _add_up(rows: DataFrame, say: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """The sum of what `say` makes of all batches of `rows`, added up in each partition first; None without any rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sum_ = None
        for batch in batches:
            if batch.num_rows:
                part = say(batch)
                sum_ = part if sum_ is None else sum_ + part
        if sum_ is not None:
            yield pa.RecordBatch.from_pydict({"s": [sum_.astype(np.float64).tobytes()]})

    # as many sums as there are cores, however many rows
    got = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "s binary").collect()
    return np.sum([np.frombuffer(r["s"]) for r in got], axis=0) if got else None


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def _joined(column: pa.BinaryArray, kind: type) -> np.ndarray:
    """The numbers of all rows of a binary column, one after the other."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].view(kind) if len(column) else np.empty(0, kind)


class _Block:
    """The described candidates of a batch: features that are there (`ids`, from `starts`) and numbers."""

    def __init__(self, batch: pa.RecordBatch):
        self.sizes = _joined(batch.column("sizes"), np.uint16)
        self.ids = _joined(batch.column("ids"), np.uint16)
        self.numbers = _joined(batch.column("numbers"), np.float32).reshape(-1, len(_NUMBERS))
        self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes

    def margin(self, theta: np.ndarray) -> np.ndarray:
        return np.add.reduceat(theta[self.ids], self.starts) + self.numbers @ theta[_NUMBERS]


def _labels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(labels, whether held out) of the described candidates of a batch."""
    return _joined(batch.column("labels"), np.int8), _joined(batch.column("held"), np.bool_)


def _teachers(described: DataFrame, before: np.ndarray | None, certain: float) -> DataFrame:
    """The candidates that teach, those of a batch in one row, with what they say and their weights: made by `cut`.

    What no pattern labels teaches as far as the model of weights `before` is sure of it.
    """
    sent = described.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            b = _Block(batch)
            label, held = _labels(batch)
            wanted = label == 1
            weight = np.where(wanted, certain, np.where(label == 0, 1.0, 0.0))
            if sent.value is not None:
                chance = _chance(b.margin(sent.value))
                wanted = np.where(label >= 0, wanted, chance > 0.2)
                weight = np.where(label >= 0, weight, np.where(chance > 0.2, 0.5, np.where(chance < 0.01, 0.3, 0.0)))
            some = ~held & (weight > 0)
            if some.any():
                parts = {"sizes": b.sizes[some], "ids": b.ids[np.repeat(some, b.sizes)], "numbers": b.numbers[some], "wanted": wanted[some], "weights": weight[some]}
                yield pa.RecordBatch.from_pydict({k: [x.tobytes()] for k, x in parts.items()})

    out = cut(described.mapInArrow(run, "sizes binary, ids binary, numbers binary, wanted binary, weights binary"), "teachers")
    sent.destroy()
    return out


def _slope(batch: pa.RecordBatch, theta: np.ndarray) -> np.ndarray:
    """The gradient at `theta` of candidates that teach, not yet divided, and behind it their weight."""
    b = _Block(batch)
    weight = _joined(batch.column("weights"), np.float64)
    off = (_chance(b.margin(theta)) - _joined(batch.column("wanted"), np.bool_)) * weight
    out = np.bincount(b.ids, np.repeat(off, b.sizes), FEATURES + 1)
    np.add.at(out, _NUMBERS, off @ b.numbers)
    out[FEATURES] = weight.sum()
    return out


def _regress(teachers: DataFrame) -> np.ndarray:
    """The regression's weights after PASSES steps, one Spark job each."""
    context = teachers.sparkSession.sparkContext
    theta, first, second = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
    for turn in range(1, PASSES + 1):
        sent = context.broadcast(theta)
        sums = _add_up(teachers, lambda batch: _slope(batch, sent.value))  # noqa: B023 - added up at once
        sent.destroy()
        if sums is None:
            break
        gradient = sums[:-1] / max(sums[-1], 1) + DECAY * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = STEP if turn <= PASSES * 2 // 3 else STEP / 3
        theta = theta - step * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-6)
    return theta


def _fit(described: DataFrame, models: tuple[np.ndarray, np.ndarray], words: Words) -> Model:
    """A model from described candidates, with these Markov models and ordinary words."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        label, held = _labels(batch)
        return np.bincount(held * 3 + label + 1, minlength=6)

    counts = _add_up(described, count)
    if counts is None:
        return Model(models, np.zeros(FEATURES), words)
    _, others, secrets, _, no, yes = map(int, counts)
    certain = min(10.0, max(1.0, others / max(1, secrets) / 4))
    theta = None
    for _ in range(3):
        teachers = _teachers(described, theta, certain)
        theta = _regress(teachers)
        drop(teachers)

    def judged(at: np.ndarray) -> np.ndarray:
        def say(batch: pa.RecordBatch) -> np.ndarray:
            label, held = _labels(batch)
            judge = held & (label >= 0)
            return _platt_sums(_Block(batch).margin(theta)[judge], label[judge], at, yes, no)

        return _add_up(described, say)

    return Model(models, theta, words, *_calibrate(judged, yes, no))


def _texts(path: str | None, content: str | None, messages) -> Iterator[tuple[str, int, Where, str]]:
    """(place, element from 1, where, text) of what a file holds."""
    if content:
        yield "content", 0, where(path), content
    for i, m in enumerate(messages if messages is not None else [], 1):
        if m:
            yield "commit_messages", i, MESSAGE, m


_MARKS_AT = ("line", "counts_at", "start", "stop")
_FOUND = pa.list_(pa.struct([(n, pa.int32()) for n in (*_MARKS_AT, "label")] + [(n, pa.string()) for n in ("value", "before", "after", "above")] + [("plain", pa.bool_())]))
_MARKED = pa.list_(pa.struct([(n, pa.int32()) for n in _MARKS_AT]))
_KEYS = pa.list_(pa.struct([(n, pa.int32()) for n in ("line", "start", "stop")]))
_TEXT = "repo string, path string, commit_hash string, version long, place string, element int, keys array<struct<line int, start int, stop int>>"
_OWN = ["repo", "path", "commit_hash", "version", "place", "element", "keys"]
_SPANS = "array<struct<element int, starts array<int>, stops array<int>>>"
#: What the texts of a row are, so that their spans find it; a null text and an empty one hold as little.
_VERSION = "xxhash64(coalesce(content, ''), transform(commit_messages, m -> coalesce(m, ''))) AS version"


def _read(files: DataFrame) -> DataFrame:
    """What all texts hold, written once: a row for each text with candidates or private keys, and for ordinary words (`word`) in how many texts (`n`) of a batch they are.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            words: dict[str, int] = {}
            for repo, path, commit, content, messages, version in zip(*[x.to_pylist() for x in batch.columns]):
                for place, element, _, text in _texts(path, content, messages):
                    found = candidates(text)
                    # ordinary words stand outside of candidates
                    parts = [text[a:b] for a, b in zip([0, *(c.end for c in found)], [*(c.start for c in found), len(text)])]
                    for w in {w.lower() for w in {w for p in parts for w in _ORDINARY.findall(p)}}:
                        words[w] = words.get(w, 0) + 1
                    keys = _private_keys(text)
                    if not found and not keys:
                        continue
                    starts, stops = _lines(text)
                    taught: dict[int, list[tuple[int, int, int]]] = {}
                    told = []
                    for c in found:
                        lo = starts[c.line - 1]
                        if c.line not in taught:
                            taught[c.line] = teach(text[lo : stops[c.line - 1]])
                        labels = [y for a, b, y in taught[c.line] if a < c.end - lo and b > c.start - lo]
                        told.append((c.line, c.counts_at, c.start, _stop(text, c), (0 if 0 in labels else 1) if labels else -1, c.value, c.before, c.after, c.above, c.plain))
                    rows.append((repo, path, commit, version, place, element, keys, told))
            columns = [list(x) + [None] * len(words) for x in (zip(*rows) if rows else [()] * 8)]
            kinds = [*[pa.string()] * 3, pa.int64(), pa.string(), pa.int32(), _KEYS, _FOUND]
            own = [pa.array(x, k) for x, k in zip(columns, kinds)]
            words_of = [pa.array([None] * len(rows) + list(x), k) for x, k in ((words, pa.string()), (words.values(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*own, *words_of], names=[*_OWN, "found", "word", "n"])

    schema = _TEXT + ", found array<struct<line int, counts_at int, start int, stop int, label int, value string, before string, after string, above string, plain boolean>>, word string, n bigint"
    return cut(files.selectExpr("repo", "path", "commit_hash", "content", "commit_messages", _VERSION).mapInArrow(read, schema), "candidates")


def _given(found: list[dict]) -> list[tuple[Candidate, int]]:
    """(candidate, label of the patterns or -1) of the candidates of a row."""
    return [(Candidate(0, 0, f["line"], f["counts_at"], f["value"], f["before"], f["after"], f["above"], f["plain"]), f["label"]) for f in found]


def _learn(files: DataFrame) -> tuple[Model, DataFrame]:
    """(a model trained on all of `files`, their texts with all candidates as the model sees them: made by `cut`)."""
    spark = files.sparkSession
    ship(spark)
    got = _read(files)
    words = got.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, kept = np.zeros(_SIZE**3, np.int64), Words()
        for batch in batches:
            # a word of many texts counts more, up to a limit
            counts += count_trigrams([w for w, n in zip(batch["word"], batch["n"]) for _ in range(min(n, 5))])
            kept.add(batch["word"])
        yield pd.DataFrame({"counts": [counts.tobytes()], "kept": [kept.bits.tobytes()]})

    # sums of a fixed size, one a partition: no list of words comes to the driver
    sums = words.coalesce(8).mapInPandas(sum_up, "counts binary, kept binary").collect()
    trigrams = np.sum([np.frombuffer(r["counts"], np.int64) for r in sums], axis=0) if sums else np.zeros(_SIZE**3, np.int64)
    kept = Words(np.bitwise_or.reduce([np.frombuffer(r["kept"], np.uint8) for r in sums])) if sums else Words()
    kept.bits = kept.bits.copy()
    kept.add(_PLACEHOLDERS)
    ordinary = log_likelihoods(trigrams)

    def strange(batch: pa.RecordBatch) -> np.ndarray:
        secret = [c for found in batch.column("found").to_pylist() for c, y in _given(found) if y == 1 and not c.plain]
        runs = [r.lower() for c in secret for r in _LETTERS.findall(_secret_of(c))]
        return count_trigrams([r for r in runs if _gain(r, (ordinary, ordinary))[1] < STRANGE])

    texts = got.filter("word is null")
    counts = _add_up(texts.select("found"), strange)
    models = (ordinary, log_likelihoods(np.zeros(_SIZE**3) if counts is None else counts))
    sent = spark.sparkContext.broadcast((models, kept))

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, kept = sent.value
        for batch in batches:
            rows = []
            for path, place, found in zip(*[batch.column(n).to_pylist() for n in ("path", "place", "found")]):
                at = where(path) if place == "content" else MESSAGE
                given = _given(found)
                seen = [describe(c, at, models, kept) for c, _ in given]
                rows.append((
                    [tuple(f[n] for n in _MARKS_AT) for f in found],
                    np.array([len(a) for a, _ in seen], np.uint16).tobytes(),
                    np.array([i for a, _ in seen for i in a], np.uint16).tobytes(),
                    np.array([b for _, b in seen], np.float32).tobytes(),
                    np.array([_label(c, y, models, kept) for c, y in given], np.int8).tobytes(),
                    # whole values are held out, so that none is judged by what it taught
                    np.array([zlib.crc32(b"held" + c.value.encode("utf-8", "surrogatepass")) % HELD_OUT == 0 for c, _ in given], np.bool_).tobytes(),
                ))
            told = [pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 6, [_MARKED, *[pa.binary()] * 5])]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in _OWN], *told], names=[*_OWN, "marks", "sizes", "ids", "numbers", "labels", "held"])

    described = cut(texts.mapInArrow(see, _TEXT + ", marks array<struct<line int, counts_at int, start int, stop int>>, sizes binary, ids binary, numbers binary, labels binary, held binary"), "described")
    sent.destroy()
    drop(got)
    model = _fit(described.filter("size(marks) > 0").select("sizes", "ids", "numbers", "labels", "held"), models, kept)
    return model, described


def train(files: DataFrame) -> Model:
    """A model trained on all candidates of all `files`."""
    model, described = _learn(files)
    drop(described)
    return model


# --- finding and redacting -------------------------------------------------------------------------------------------

_MASK = "REDACTED"
_REST_OF_VALUE = re.compile(r"(?:[A-Za-z0-9!#$%^&*+~._-]|/(?=[A-Za-z0-9+/]{6,}))*={0,2}")


def _private_keys(text: str) -> list[tuple[int, int, int]]:
    """(line of the opening, from 1, start, end) of the private keys of a text."""
    if "-----BEGIN " not in text:
        return []
    starts, _ = _lines(text)
    # a key has a body that is not just a remark
    return [(bisect_right(starts, a - 1), a, b) for a, b, private in key_blocks(text) if private and len(re.sub(r"\W", "", text[a:b])) >= 16]


def _stop(text: str, c: Candidate) -> int:
    """Where the value ends that a candidate begins."""
    return _REST_OF_VALUE.match(text, c.end).end()


def _judge(keys: Iterable[tuple], marks: list[tuple], score: np.ndarray, least: float) -> tuple[list[int], list[tuple[int, int]]]:
    """(lines that hold a secret, spans) of a text with these private keys and candidates (line, counts_at, start, stop)."""
    lines, spans = {n for n, _, _ in keys}, [(a, b) for _, a, b in keys]
    # parts of one secret, each none too sure, speak for it together
    none: dict[int, float] = {}
    for (_, n, _, _), p in zip(marks, score):
        none[n] = none.get(n, 1.0) * (1 - p)
    sure = {n for n, q in none.items() if 1 - q >= least}
    spans += [(a, b) for (line, n, a, b), p in zip(marks, score) if n in sure and (p >= least / 4 or line != n)]
    return sorted(lines | sure), sorted(spans)


def secrets(text: str, at: Where, model: Model) -> tuple[list[int], list[tuple[int, int]]]:
    """(lines that hold a secret, from 1; the spans of the secret values) of a text."""
    found = candidates(text)
    marks = [(c.line, c.counts_at, c.start, _stop(text, c)) for c in found]
    return _judge(_private_keys(text), marks, model.score(found, at), model.sure)


def _judged(batch: pa.RecordBatch, model: Model) -> Iterator[tuple]:
    """(repo, path, commit_hash, version, place, element, lines, spans) of each described text of a batch."""
    block, at = _Block(batch), 0
    score = model.likely(block.margin(model.weights)) if len(block.sizes) else np.empty(0)
    for *own, keys, marks in zip(*[batch.column(n).to_pylist() for n in [*_OWN, "marks"]]):
        lines, spans = _judge([tuple(k.values()) for k in keys], [tuple(m.values()) for m in marks], score[at : at + len(marks)], model.sure)
        at += len(marks)
        yield *own, lines, spans


def redact(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` with each span replaced: a word for a value, and for a block one for each of its lines."""
    out, at = [], 0
    for a, b in spans:
        if a < at:
            continue
        out.append(text[at:a])
        body = text[a:b]
        if "\n" in body or "\r" in body:
            # line ends, blanks and marks stay, so the block keeps its form
            out.append(re.sub(r"[A-Za-z0-9+/=:,-]{4,}[^\r\n\\\"']*", _MASK, body))
        elif "\\n" in body:
            out.append("\\n" + _MASK + "\\n")
        else:
            out.append(_MASK)
        at = b
    out.append(text[at:])
    return "".join(out)


def find_secrets(files: DataFrame, model: Model | None = None) -> DataFrame:
    """(repo, path, commit_hash, place, line_no): see TESTDATA, p5_found.

    Repeated rows of a version count once; null or empty contents and messages hold nothing; null names stay null.
    Texts are read whole. Further columns are ignored, and an empty table gives no rows.
    """
    spark = files.sparkSession
    ship(spark)
    texts = files.select("repo", "path", "commit_hash", "content", "commit_messages")
    # a model that is trained here has seen all candidates: they are judged as it saw them, and no text is read again
    seen = model is None
    if seen:
        model, texts = _learn(files)
    sent = spark.sparkContext.broadcast(model)

    def told(repo, path, commit, place, element, lines) -> list[tuple]:
        return [(repo, path, commit, place, n) for n in lines] if place == "content" else [(repo, path, commit, place, element)] * bool(lines)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.string()] * 4, pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names=["repo", "path", "commit_hash", "place", "line_no"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for repo, path, commit, content, messages in zip(*[x.to_pylist() for x in batch.columns]):
                for place, element, at, text in _texts(path, content, messages):
                    rows += told(repo, path, commit, place, element, secrets(text, at, sent.value)[0])
            yield table(rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table([r for repo, path, commit, _, place, element, lines, _ in _judged(batch, sent.value) for r in told(repo, path, commit, place, element, lines)])

    return texts.mapInArrow(judge if seen else run, "repo string, path string, commit_hash string, place string, line_no int").distinct()


def redact_secrets(files: DataFrame, model: Model | None = None) -> DataFrame:
    """(repo, path, commit_hash, content, commit_messages, secrets): each row with the secret values replaced.

    `secrets` counts the replaced spans. Every row comes out, repeated ones as often; nulls stay null, and a text
    without secrets comes out as it is, byte for byte.
    """
    spark = files.sparkSession
    ship(spark)
    columns = ["repo", "path", "commit_hash", "content", "commit_messages"]
    texts = files.select(*columns, F.lit(None).cast(_SPANS).alias("spans"))
    # a model that is trained here has seen all candidates: their spans go to the texts, which are not read again
    seen = model is None
    if seen:
        model, described = _learn(files)
    sent = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*own, [a for a, _ in spans], [b for _, b in spans]) for *own, _, spans in _judged(batch, sent.value) if spans]
            kinds = [*[pa.string()] * 3, pa.int64(), pa.string(), pa.int32(), *[pa.list_(pa.int32())] * 2]
            names = ["repo", "path", "commit_hash", "version", "place", "element", "starts", "stops"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 8, kinds)], names=names)

    if seen:
        key = ["repo", "path", "commit_hash", "version"]
        spans = described.mapInArrow(judge, "repo string, path string, commit_hash string, version long, place string, element int, starts array<int>, stops array<int>")
        # repeated rows say the same
        spans = spans.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.collect_set(F.struct("element", "starts", "stops")).alias("spans"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
        texts = files.selectExpr(*columns, _VERSION).join(spans, same, "left").select(*columns, "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, contents, messages_out = [], [], []
            for path, content, messages, known in zip(batch["path"], batch["content"], batch["commit_messages"], batch["spans"]):
                n = 0
                told = None if messages is None else list(messages)
                # element 0 is the content
                of = {x["element"]: list(zip(x["starts"], x["stops"])) for x in ([] if known is None else known)}
                for place, element, at, text in _texts(path, content, messages):
                    spans = of.get(element, []) if seen else secrets(text, at, sent.value)[1]
                    n += len(spans)
                    if spans and place == "content":
                        content = redact(text, spans)
                    elif spans:
                        told[element - 1] = redact(text, spans)
                counts.append(n)
                contents.append(content)
                messages_out.append(told)
            yield batch[["repo", "path", "commit_hash"]].assign(content=contents, commit_messages=messages_out, secrets=np.array(counts, np.int32))

    return texts.mapInPandas(run, "repo string, path string, commit_hash string, content string, commit_messages array<string>, secrets int")
