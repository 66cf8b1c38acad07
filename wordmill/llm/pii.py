"""Personal data: base patterns, and a semi-Markov conditional random field for what they miss.

The model scores whole candidate segments: features see the full span (its shape, digits, checksums, the words around
it), and dynamic programming over segments of at most ``MAX_TOKENS`` tokens chooses boundaries and types jointly. Only
a segment that holds a trigger (two digits together, an @, a long word of letters and digits, the word after a secret's
cue, "at host dot end") can be an entity; tokens that
no such segment reaches are outside for certain and add nothing, so decoding the stretches around triggers gives the
best labelling of the whole text. The model is trained by maximum likelihood on sentences made here from templates.

Defined results: a null text counts as empty (redacted it stays null); a text without digits, @ and the like has no spans.
Base spans always stay, and a model span that meets one is dropped. Each row is judged by its own text alone, so repeated
rows and ties get equal results. Very long texts are read whole, stretch by stretch. An empty table gives an empty one. Other
columns are kept; a column ``pii_spans`` is replaced by :func:`with_spans`. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytewords as bw

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "secret")
MAX_TOKENS = 9
#: Most words without a digit in a segment; written-out mail with dots on both sides has nine.
MAX_WORDS = 9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits that doesn't match from its start doesn't match from a later digit either
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each @ is visited once: the local part is the run of its characters to the left, up to the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {"email": _emails(text), "ip": [], "card": [], "phone": []}
    for m in _IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".") if len(p.lstrip("0")) <= 3) and all(len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                out["phone"].append(m.span())
    return out


# ---------------------------------------------------------------- model

_TOKEN = re.compile(r"[\[(](?:at|dot)[\])]|\w+|[^\w\s]", re.I)
_SECRET_CUES = ("token", "key", "secret", "password", "passwd", "pwd", "apikey", "credential", "auth", "bearer")
#: Where a group matched, it is the trigger: the word after a cue, which may be the cue of a next one.
_TRIGGER = re.compile(
    r"[0-9]{2,}|@|[\[(](?:at|dot)[\])]|\bdot\s(?:com|org|net|edu)\b|\bat\s[\w.-]{1,64}\sdot\s[\w-]+"
    r"|\b(?=\w*[0-9])(?=\w*[^\W\d_])\w{16,}|\b(?-i:AKIA|ASIA|AIza|ghp_|gho_|ghs_|glpat-|xoxb-|xoxp-|sk_live_|sk_test_|sk-|eyJ)\w{8,}|\b[A-Z]{2}[0-9]{2}\x20[A-Z]{4}\b"
    rf"|(?:{'|'.join(_SECRET_CUES)})s?[\"']?(?:\s{{0,3}}[=:]{{1,2}}\s{{0,3}}|(?<=bearer)\s|(?<=\bpassword)\sis\s)[\"']?(?=(\w+))",
    re.I,
)
_CUES = {
    "secret": _SECRET_CUES,
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "contact"),
    "card": ("card", "visa", "credit", "debit", "payment", "mastercard"),
    "email": ("email", "mail", "write", "mailto", "contact"),
    "ip": ("ip", "host", "server", "address", "login"),
    "iban": ("iban", "account", "bank", "transfer"),
    "national_id": ("ssn", "social", "security", "insurance", "national", "id"),
    "other": ("version", "page", "pages", "section", "chapter", "figure", "table", "isbn", "order", "invoice", "total", "year", "years", "since", "line", "sha", "commit", "hash", "build", "release", "rfc", "no", "vol", "date"),
}
_CUE_OF = {w: k for k, ws in _CUES.items() for w in ws}


def _iban_ok(s: str) -> bool:
    if not (15 <= len(s) <= 34 and s[:2].isalpha() and s[2:4].isdigit() and s.isascii() and s.isalnum()):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


_FLIP = re.compile(r"[a-z][A-Z]|[A-Za-z][0-9]|[0-9][A-Za-z]")
_HARD = re.compile(r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]+")
#: How keys of some public services begin.
_KEY_PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk_test_", "sk-", "eyJ")


@functools.lru_cache(50_000)
def _shape(s: str) -> str:
    """Digits as d with their number, letters as a, spaces as they are; runs of letters collapse."""
    s = re.sub(r"[A-Za-z]+", "a", re.sub(r"[^\W\dA-Za-z]+", "u", s))
    return re.sub(r"\d+", lambda m: f"d{len(m.group())}" if len(m.group()) < 7 else "d+", s)[:40]


def segment_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Features of the whole segment of tokens i..j-1."""
    start, end = tokens[i][0], tokens[j - 1][1]
    s = text[start:end]
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    before = [text[a:b].lower() for a, b in tokens[max(0, i - 4) : i]]
    cues = {_CUE_OF[w] for w in before if w in _CUE_OF}
    out = ["1", f"shape={_shape(s)}", f"tokens={min(j - i, 9)}", f"digits={min(digits, 25)}", f"letters={min(letters, 8)}"]
    out += [f"cue={c}" for c in cues] or ["nocue"]
    out += [f"cue={c}&digits={min(digits, 25)}" for c in cues]
    out.append(f"first={s[0] if not s[0].isalnum() else 'd' if s[0].isdigit() else 'a'}")
    out.append(f"last={s[-1] if not s[-1].isalnum() else 'd' if s[-1].isdigit() else 'a'}")
    left, right = text[start - 1 : start], text[end : end + 1]
    out.append(f"left={'^' if not left else 'w' if left.isalnum() else ' ' if left.isspace() else left}")
    out.append(f"right={'$' if not right else 'w' if right.isalnum() else ' ' if right.isspace() else right}")
    if digits and digits == len(s):
        out.append(f"alldigits={min(digits, 20)}")
    if 13 <= digits <= 19 and not letters:
        out.append("luhn" if luhn(_NO_DIGIT.sub("", s) or "1") else "noluhn")
    if "@" in s:
        out.append("at")
    if re.fullmatch(r"\S+@\S+\.\w+", s):
        out.append("mailshape")
    if re.search(r"(?i)\b(?:at)\b|[\[(]at[\])]", s) and re.search(r"(?i)\bdot\b|\.", s):
        out.append("atdot")
    compact = s.replace(" ", "")
    if _iban_ok(compact.upper()):
        out.append("iban97")
    if len(s) >= 16 and " " not in s and digits and letters:
        out.append("mixed16")
        if re.fullmatch(r"[0-9a-fA-F]+", s):
            out.append("hex16")
    if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", s):
        out.append("id324")
    if cues or len(s) >= 16:
        edge = text[max(0, start - 3) : start].rstrip(" ")[-1:]
        out.append(f"edge={edge if edge and not edge.isalnum() else 'w'}&{'secret' if 'secret' in cues else 'plain'}")
        out.append(f"len={min(len(s) // 6, 7)}&blank={' ' in s}&digit={digits > 0}")
    if letters >= 6 and " " not in s:
        out.append(f"flips={min(len(_FLIP.findall(s)), 4)}")
        out.append(f"hard={min(max(map(len, _HARD.findall(s)), default=0), 6)}")
    if s.startswith(_KEY_PREFIXES):
        out.append("keyprefix")
    if s.count("(") != s.count(")") or s.count("[") != s.count("]"):
        out.append("unbalanced")
    if "\n" in s:
        out.append("newline")
    return out


#: Tokens that a stretch has before and after its triggers, more than an entity reaches.
_MARGIN = MAX_TOKENS + 4


def _around(text: str, low: int, high: int) -> list[tuple[int, int]]:
    """Tokens of a window that has at least _MARGIN of them before ``low`` and after ``high``, or reaches the text's ends."""
    wide = 200
    while True:
        a, b = max(0, low - wide), min(len(text), high + wide)
        while a > 0 and (text[a - 1].isalnum() or text[a - 1] == "_"):
            a -= 1
        while b < len(text) and (text[b].isalnum() or text[b] == "_"):
            b += 1
        tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
        if (a == 0 or sum(e <= low for _, e in tokens[: _MARGIN + 1]) > _MARGIN) and (b == len(text) or sum(s >= high for s, _ in tokens[-_MARGIN - 1 :]) > _MARGIN):
            return tokens
        wide *= 2


def stretches(text: str) -> list[tuple[list[tuple[int, int]], list[bool]]]:
    """Tokens around triggers, with a margin that no entity can cross, and which of them hold a trigger."""
    hits = [m.span(m.lastindex or 0) for m in _TRIGGER.finditer(text)]
    out = []
    k = 0
    while k < len(hits):
        high, n = hits[k][1], k + 1
        while n < len(hits) and hits[n][0] - 800 <= high:
            high = hits[n][1]
            n += 1
        tokens = _around(text, hits[k][0], high)
        while n < len(hits) and hits[n][0] <= tokens[-1][1]:  # the margin met another trigger
            high = hits[n][1]
            n += 1
            if n == len(hits) or hits[n][0] > tokens[-1][1]:
                tokens = _around(text, hits[k][0], high)
        held = np.zeros(len(tokens), bool)
        starts = np.array([a for a, _ in tokens])
        ends = np.array([b for _, b in tokens])
        for a, b in hits[k:n]:
            held[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = True
        near = np.flatnonzero(held)
        if len(near):
            cut = np.flatnonzero(np.diff(near) > 2 * _MARGIN)
            for a, b in zip(np.append(near[0], near[cut + 1]), np.append(near[cut], near[-1])):
                a, b = max(0, a - _MARGIN), min(len(tokens), b + _MARGIN + 1)
                out.append((tokens[a:b], held[a:b].tolist()))
        k = n
    return out


def candidates(text: str, tokens: list[tuple[int, int]], held: list[bool]) -> list[tuple[int, int]]:
    """Segments that may be an entity: they hold a trigger, lie in one line, have no wide gap, begin with a letter, a
    digit or one of ``+([``, and have at most MAX_WORDS plain words."""
    out = []
    n = len(tokens)
    word = [text[a].isalpha() and not any(c.isdigit() for c in text[a:b]) for a, b in tokens]
    opens = [text[a].isalnum() or text[a] in "+([" for a, _ in tokens]
    for i in range(n):
        if not opens[i]:
            continue
        words, trigger = 0, False
        for j in range(i, min(n, i + MAX_TOKENS)):
            if j > i:
                gap = tokens[j][0] - tokens[j - 1][1]
                if gap > 1 or gap and text[tokens[j][0] - 1] in "\n\r":
                    break
            words += word[j]
            if words > MAX_WORDS:
                break
            trigger = trigger or held[j]
            if trigger and text[tokens[j][1] - 1].isalnum():
                out.append((i, j + 1))
    return out


class SemiMarkovCRF:
    """Label 0 is outside (one token a segment); labels 1.. are KINDS. Weights: label by feature, and label by label."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.w = np.zeros((len(KINDS), len(names)))
        self.t = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def indices(self, features: list[str]) -> list[int]:
        get = self.names.get
        return [k for f in features if (k := get(f)) is not None]

    def lattice(self, text, tokens, held):
        segs = candidates(text, tokens, held)
        feats = [self.indices(segment_features(text, tokens, i, j)) for i, j in segs]
        return len(tokens), segs, feats

    def scores(self, feats) -> np.ndarray:
        flat = np.concatenate([np.asarray(f, np.int64) for f in feats])
        at = np.concatenate([[0], np.cumsum([len(f) for f in feats])[:-1]])
        return np.add.reduceat(self.w[:, flat], at, axis=1).T

    def best(self, lattice) -> list[tuple[int, int, int]]:
        n, segs, feats = lattice
        if not segs:
            return []
        s = self.scores(feats)
        k = len(KINDS) + 1
        begin = np.array([i for i, _ in segs])
        by_end: dict[int, list[int]] = {}
        for x, (_, j) in enumerate(segs):
            by_end.setdefault(j, []).append(x)
        v = np.full((n + 1, k), -np.inf)
        v[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            into = v[j - 1] + self.t[:, 0]
            v[j, 0] = into.max()
            back[j, 0] = (j - 1, int(into.argmax()))
            if xs := by_end.get(j):
                into = v[begin[xs]][:, :, None] + self.t[None, :, 1:]
                total = into.max(axis=1) + s[xs]
                first = total.argmax(axis=0)
                for lab, x in enumerate(first.tolist()):
                    v[j, lab + 1] = total[x, lab]
                    back[j, lab + 1] = (segs[xs[x]][0], int(into[x, :, lab].argmax()))
        out = []
        j, lab = n, int(v[n].argmax())
        while j > 0:
            i, prev = back[j, lab]
            if lab:
                out.append((i, j, lab - 1))
            j, lab = i, prev
        return out[::-1]

    def gradient(self, lattice, gold: list[tuple[int, int, int]]):
        """Log-likelihood of the gold segments, and its gradient as segment-by-label and label-by-label counts."""
        n, segs, feats = lattice
        s = self.scores(feats) if segs else np.zeros((0, len(KINDS)))
        k = len(KINDS) + 1
        begin, end = (np.array([seg[m] for seg in segs], dtype=np.int64) for m in (0, 1))
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for x, (i, j) in enumerate(segs):
            by_end.setdefault(j, []).append(x)
            by_start.setdefault(i, []).append(x)

        def lse(a, axis):
            top = a.max(axis=axis, keepdims=True)
            top = np.where(np.isfinite(top), top, 0)
            return (np.log(np.exp(a - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

        with np.errstate(divide="ignore"):
            f = np.full((n + 1, k), -np.inf)
            f[0, 0] = 0
            for j in range(1, n + 1):
                f[j, 0] = lse(f[j - 1] + self.t[:, 0], 0)
                if xs := by_end.get(j):
                    f[j, 1:] = lse(lse(f[begin[xs]][:, :, None] + self.t[None, :, 1:], 1) + s[xs], 0)
            b = np.full((n + 1, k), -np.inf)
            b[n] = 0
            for i in range(n - 1, -1, -1):
                outside = self.t[:, 0] + b[i + 1, 0]
                if xs := by_start.get(i):
                    inside = (s[xs] + b[end[xs], 1:])[:, None, :] + self.t[None, :, 1:]
                    b[i] = np.logaddexp(outside, lse(inside.transpose(1, 0, 2).reshape(k, -1), 1))
                else:
                    b[i] = outside
            z = lse(f[n], 0)
            gs, gt = np.zeros_like(s), np.zeros_like(self.t)
            gt[:, 0] -= np.exp(f[:-1] + self.t[:, 0] + b[1:, :1] - z).sum(axis=0)
            if len(segs):
                p = np.exp(f[begin][:, :, None] + self.t[None, :, 1:] + (s + b[end, 1:])[:, None, :] - z)
                gs -= p.sum(axis=1)
                gt[:, 1:] -= p.sum(axis=0)
        where = {seg: x for x, seg in enumerate(segs)}
        score, prev, at = 0.0, 0, 0
        for i, j, lab in [*gold, (n, n, None)]:
            if i > at:
                score += self.t[prev, 0] + (i - at - 1) * self.t[0, 0]
                gt[prev, 0] += 1
                gt[0, 0] += i - at - 1
                prev = 0
            if lab is None:
                break
            x = where[i, j]
            score += self.t[prev, lab + 1] + s[x, lab]
            gt[prev, lab + 1] += 1
            gs[x, lab] += 1
            prev, at = lab + 1, j
        return score - z, gs, gt


def _number(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _with_luhn(digits: str) -> str:
    return next(digits[:-1] + c for c in "0123456789" if luhn(digits[:-1] + c))


def _make(r: random.Random, kind: str) -> tuple[str, str]:
    """An entity of a kind, and words that may stand before it."""
    word = lambda: "".join(r.choice(("an", "el", "th", "or", "mi", "ka", "so", "ver", "lin")) for _ in range(r.randint(1, 3)))
    n = lambda k: _number(r, k)
    if kind == "email":
        user, host, end = word() + r.choice(("", ".", "_")) + r.choice((n(2), word())), r.choice(("mail", "example", word())) + r.choice(("", n(1))), r.choice(("com", "org", "net", "edu"))
        return r.choice((f"{user}@{host}.{end}", f"{user}@{host}.{end}", f"{user} [at] {host} dot {end}", f"{user} (at) {host}.{end}", f"{word()} at {host} dot {end}", f"{word()} [at] {word()} [dot] {host} [dot] {end}")), r.choice(("", "", "email ", "mail: ", "write to "))
    if kind == "ip":
        return ".".join(str(r.randint(0, 255)) for _ in range(4)), r.choice(("", "", "ip ", "host ", "server "))
    if kind == "card":
        d = n(r.choice((15, 16, 16, 16, 16)))
        d = _with_luhn(d) if r.random() < 0.4 else d
        return r.choice((d, d, " ".join(d[k : k + 4] for k in range(0, len(d), 4)), "-".join(d[k : k + 4] for k in range(0, len(d), 4)))), r.choice(("", "", "", "card ", "visa: "))
    if kind == "phone":
        a, b, c = n(3), n(3), n(4)
        return r.choice((f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{n(2)} {n(2)} {n(3)} {n(4)}", f"({a}) {b} {c}", f"{a}.{b}.{c}")), r.choice(("", "", "phone ", "call ", "tel: "))
    if kind == "iban":
        country, body = r.choice((("DE", n(18)), ("FR", n(23)), ("ES", n(20)), ("GB", "".join(r.choice("ABCDEFGHIKLMNOPRSTW") for _ in range(4)) + n(14)), ("NL", "".join(r.choice("ABCDEFGHIKLMNOPRSTW") for _ in range(4)) + n(10))))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country) + "00") % 97
        s = f"{country}{check:02d}{body}"
        return r.choice((s, " ".join(s[k : k + 4] for k in range(0, len(s), 4)))), r.choice(("", "iban ", "account ", "iban: ", "to "))
    if kind == "national_id":
        return f"{n(3)}-{n(2)}-{n(4)}", r.choice(("", "", "ssn ", "social security "))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    lead = r.choice(("token = ", "TOKEN = ", "key: ", "secret=", "password = ", "apikey = ", "secret_key = ", "password: ", "api key "))
    form = r.random()
    if form < 0.15:  # passwords, of letters alone too; these stand after a cue that ends in a mark
        return some(r.choice((lower, lower + digits, lower + upper, lower + upper + digits)), r.randint(8, 30)), r.choice(("password: ", "password = ", "pwd=", "passwd: ", "secret: ", "password is "))
    if form < 0.3:
        s = r.choice(("AKIA" + some(upper + digits, 16), "AIza" + some(lower + upper + digits + "_", 14) + r.choice(("-", "_")) + some(lower + upper + digits, 20), "ghp_" + some(lower + upper + digits, 36), "sk_live_" + some(lower + digits, 24), "xoxb-" + n(11) + "-" + some(lower + upper + digits, 24)))
        return s, r.choice(("", "the key ", "api key ", lead))
    if form < 0.36:
        return f"{some(lower + upper + digits, r.randint(8, 14))}/{some(lower + upper + digits, r.randint(6, 12))}{r.choice(('/', '+'))}{some(lower + upper + digits, 16)}", lead
    s = some(r.choice((digits + "abcdef", digits + "ABCDEF", lower + upper + digits)), r.choice((24, 32, 40, 40, 48)))
    return (s, lead + '"') if r.random() < 0.7 else (s, lead)


def _plain(r: random.Random) -> str:
    """Numbers and codes that are no personal data."""
    n = lambda k: _number(r, k)
    date = f"{r.randint(1, 28)}"
    return r.choice(
        (
            f"in {r.randint(1800, 2030)}", f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{date}", f"{date}/{r.randint(10, 12)}/{r.randint(1990, 2030)}", f"version {r.randint(1, 30)}.{r.randint(0, 20)}", f"version {r.randint(1, 30)}.{r.randint(0, 20)}.{r.randint(10, 99)}",
            f"{n(2)}%", f"{n(2)},{n(3)}", f"${n(3)}.{n(2)}", f"{r.randint(10, 23)}:{n(2)}", f"page {n(3)}", f"pages {n(2)}-{n(3)}", f"section {r.randint(1, 30)}.{r.randint(10, 30)}", f"order {n(8)}", f"invoice {n(6)}", f"RFC {n(4)}", f"commit {''.join(r.choice('0123456789abcdef') for _ in range(40))}",
            f"isbn 978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", f"{n(5)}", f"{n(7)}", f"{n(10)}", f"{n(2)} {n(2)} {n(2)}", f"1{n(2)} x 2{n(2)}", f"#{n(6)}", f"model{n(3)}", f"{n(2)}.{n(4)}", f"build {n(4)}.{n(2)}.{n(3)}",
            f"key: use {r.choice(('the', 'an', 'good', 'other'))} words", "the key is in the house", "password is needed here", "password is the same", "a secret: we know nothing", "the token = one step", f"meet at {r.choice(('noon', 'home', 'work'))} dot", f"at {r.choice(('ten', 'one'))} dot matrix printers", "keyboards and passwords", "token economy: simple words",
        )
    )


def training_sentences(count: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with gold spans (start, end, kind), made from a fixed seed."""
    r = random.Random(seed)
    syllables = ("the", "an", "er", "ion", "que", "de", "la", "sch", "ung", "ente", "ó", "é", "ing", "ly", "ver", "ar")
    out = []
    for _ in range(count):
        text, gold = "", []
        for _ in range(r.randint(1, 3)):
            for _ in range(r.randint(1, 9)):
                w = "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
                text += (w.capitalize() if r.random() < 0.15 else w) + r.choice((" ", " ", " ", " ", ", ", ". ", " | ", "\n", "*** "))
            if r.random() < 0.62:
                kind = r.randrange(len(KINDS))
                entity, lead = _make(r, KINDS[kind])
                gold.append((len(text) + len(lead), len(text) + len(lead) + len(entity), kind))
                text += lead + entity + ('"' if lead.endswith('"') else "") + r.choice((" ", " ", ".", ",", "### ", "!! ", "\n"))
            else:
                text += _plain(r) + r.choice((" ", " ", ". ", ", ", "\n"))
        out.append((text if r.random() < 0.8 else text.upper(), gold))
    return out


@functools.lru_cache(4)
def trained(count: int = 1200, epochs: int = 5, seed: int = 3, rate: float = 0.25, decay: float = 1e-4) -> SemiMarkovCRF:
    """Weights by stochastic gradient steps (AdaGrad) on the log-likelihood; the same on each run."""
    data, names, seen = [], {}, {}
    for text, gold in training_sentences(count, seed):
        for tokens, held in stretches(text):
            starts, ends = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
            segs = candidates(text, tokens, held)
            allowed = set(segs)
            own = [(*seg, kind) for a, b, kind in gold if (seg := (starts.get(a), ends.get(b))) in allowed]
            raw = [segment_features(text, tokens, i, j) for i, j in segs]
            for f in {x for fs in raw for x in fs}:
                seen[f] = seen.get(f, 0) + 1
            data.append((len(tokens), segs, raw, own))
    for f in sorted(f for f, n in seen.items() if n > 1):
        names[f] = len(names)
    model = SemiMarkovCRF(names)
    lattices = [((n, segs, [model.indices(fs) for fs in raw]), own) for n, segs, raw, own in data]
    sw, st = np.full_like(model.w, 1e-8), np.full_like(model.t, 1e-8)
    r = random.Random(seed)
    for _ in range(epochs):
        r.shuffle(lattices)
        for lattice, own in lattices:
            _, gs, gt = model.gradient(lattice, own)
            busy = np.flatnonzero(np.abs(gs).sum(axis=1) > 1e-4)
            if len(busy):
                flat = np.concatenate([np.asarray(lattice[2][x], np.int64) for x in busy])
                g = np.repeat(gs[busy], [len(lattice[2][x]) for x in busy], axis=0)
                ids, inverse = np.unique(flat, return_inverse=True)
                total = np.zeros((len(ids), len(KINDS)))
                np.add.at(total, inverse, g)
                total = total.T - decay * model.w[:, ids]
                sw[:, ids] += total**2
                model.w[:, ids] += rate * total / np.sqrt(sw[:, ids])
            st += gt**2
            model.t += rate * gt / np.sqrt(st)
    return model


# ---------------------------------------------------------------- operator


def model_spans(model: SemiMarkovCRF, text: str) -> list[tuple[int, int, str]]:
    out = []
    for tokens, held in stretches(text):
        for i, j, lab in model.best(model.lattice(text, tokens, held)):
            out.append((tokens[i][0], tokens[j - 1][1], KINDS[lab]))
    return out


def all_spans(model: SemiMarkovCRF, text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans, and all spans by kind, then start."""
    base = base_spans(text)
    taken = sorted(s for spans in base.values() for s in spans)
    begins = [a for a, _ in taken]
    furthest = np.maximum.accumulate([b for _, b in taken]) if taken else []
    out = [(k, a, b) for k in BASE_KINDS for a, b in base[k]]
    for a, b, kind in model_spans(model, text):
        n = int(np.searchsorted(begins, b, "left"))
        if n == 0 or furthest[n - 1] <= a:
            out.append((kind, a, b))
    return base, sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _find(weights, redacted: str | None = None):
    """Adds the column pii_spans; or, with the name of a column (which may be absent) of text lengths, redacts."""
    names, w, t = weights

    def run(batches):
        model = SemiMarkovCRF(names)
        model.w, model.t = w, t
        for batch in batches:
            for part in bw.slices(batch, "text"):
                spans, texts = [], part.column("text").to_pylist()
                for k, text in enumerate(texts):
                    base, every = all_spans(model, text or "")
                    if redacted is None:
                        fixed = {(kind, *s) for kind in BASE_KINDS for s in base[kind]}
                        spans.append([{"kind": kind, "start": a, "end": b, "base": (kind, a, b) in fixed} for kind, a, b in every])
                    elif every:
                        texts[k] = redact_text(text, [(a, b, kind) for kind, a, b in every])
                        spans.append(k)
                if redacted is None:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, _SPAN_TYPE)], [*part.schema.names, "pii_spans"])
                elif not spans:
                    yield part
                else:
                    part = part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, part.column("text").type))
                    if redacted in part.schema.names:
                        lengths = part.column(redacted).to_pylist()
                        for k in spans:
                            lengths[k] = len(texts[k])
                        part = part.set_column(part.schema.get_field_index(redacted), redacted, pa.array(lengths, part.column(redacted).type))
                    yield part

    return run


SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text) and ``pii_spans``: all spans by kind as in KINDS, then start."""
    model = trained()
    docs = docs.drop("pii_spans")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_find((model.names, model.w, model.t)), f"{columns}, pii_spans {SPANS}")


def redact_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a < at:  # two kinds met: the stretch both cover gets one mark
            at = max(at, b)
            continue
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, length: str = "n_chars") -> DataFrame:
    """``docs`` with each span of the text replaced by ``<KIND>``. Where a text changes, a column of the name ``length``, if
    there is one, gets the text's new number of characters. All other columns are kept, ``pii_spans`` too."""
    model = trained()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_find((model.names, model.w, model.t), redacted=length), columns)


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def share_found(model: SemiMarkovCRF, sentences) -> tuple[float, float]:
    """Precision and recall of exact spans on labelled texts."""
    right = found = there = 0
    for text, gold in sentences:
        got = set(model_spans(model, text))
        want = {(a, b, KINDS[k]) for a, b, k in gold}
        right, found, there = right + len(got & want), found + len(got), there + len(want)
    return right / max(found, 1), right / max(there, 1)
