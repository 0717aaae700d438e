"""Personal data: exact patterns, and a character-level BiLSTM-CRF for other spellings.

The patterns give the base spans.  A tagger, trained in numpy from labelled spans
(the base spans of a bounded sample, and the same spans respelled), then reads
windows around digits, at-signs and spelled-out ones (``_AT``) that no base span
covers: every span that ``plausible`` accepts holds one of these.  Windows overlap
by half; a span is taken from windows that see all of it, a window that cuts one is
read again twice as wide, until the span or the text ends, and of all windows' spans
of a text the set without overlaps that has the greatest sum of scores is kept.
A span of more than ``MAX_SPAN`` characters is no such datum, so windows grow no further than twice that.

Secrets (keys, tokens, passwords that are stated as such) are a label of their own, by patterns.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.text import forget_in_worker

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "secret")
SAMPLE_ROWS = 600       # documents with base spans that the tagger learns from
WINDOW, STRIDE = 96, 48
MIN_POSTERIOR = 0.5     # least mean posterior of a span that the tagger adds
SURE_POSTERIOR = 0.95   # and of an e-mail address without a dot after its at-sign
HIDDEN, EMBED = 20, 12
EPOCHS = 14
LEARNT = 64             # characters of a window of the fit
COPIES = 12             # respelled windows that the tagger learns from for each labelled span
MAX_SPAN = 2048         # characters of a datum at most (an e-mail address has 254; written out, more)

# the base patterns; possessive or anchored forms of the contract's, with the same matches in linear time
_AT_LEFT = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_AT_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = r"@| at |\[at\]|\(at\)"       # what an e-mail holds at least
_DOT = re.compile(rf"(?:{_AT}).*[^ ](?:\.| dot )", re.DOTALL)
_ANCHOR = re.compile(rf"[0-9]|{_AT}")


#: Secrets: a value that is said to be one, and keys of well-known forms.  Group 1 or 2 is the secret.
_SECRET = re.compile(
    r"""(?<![A-Za-z0-9])(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key|client[_-]?secret|auth)"""
    r"""["']?[ \t]{0,8}[:=][ \t]{0,8}["']?([A-Za-z0-9+/_.=-]{8,})"""
    r"""|((?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}"""
    r"""|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*)|-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----)""",
    re.IGNORECASE)
_HINTS = ("token", "secret", "passw", "pwd", "key", "auth", "akia", "asia", "gho_", "ghp_", "ghr_", "ghs_", "ghu_", "xox", "sk-", "eyj")
SECRET = len(KINDS)     # the kind's number after the contract's four; ``spans`` never holds it


def secret_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, SECRET, end) of every secret, leftmost first; a stated value needs a digit, so that words don't count."""
    if not text:
        return []
    low = text.lower()
    if not any(h in low for h in _HINTS):          # every pattern holds one of these
        return []
    out = []
    for m in _SECRET.finditer(text):
        a, b = m.span(1) if m[1] else m.span(2)
        if m[2] or any(c in "0123456789" for c in m[1]):
            out.append((a, SECRET, b))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the exact patterns, by start, then kind."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _AT_RIGHT.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        else:
            done = max(done, at)                 # no later match reaches over an at-sign
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- the tagger -------------------------------------------------------------

_N_TAGS = 1 + 2 * len(KINDS)           # outside; begin and inside of each kind
_OTHER = 97                            # ids: 0 padding, 1..96 printable ASCII and newline, then others
_IDS = np.full(0x10000, _OTHER + 1, dtype=np.uint8)   # letters beyond ASCII and all else
_IDS[:128] = _OTHER
_IDS[32:127] = np.arange(1, 96)
_IDS[10] = 96


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _IDS[np.minimum(points, 0xFFFF)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x, w, b, training: bool = True):
    """x (T, B, E) -> h (T, B, H), and, ``training``, what the backward pass needs."""
    t, n, _ = x.shape
    hid = w.shape[1] // 4
    h, c = np.zeros((n, hid), x.dtype), np.zeros((n, hid), x.dtype)
    out, keep = np.empty((t, n, hid), x.dtype), []
    into = x @ w[:x.shape[2]] + b
    back = w[x.shape[2]:]
    for i in range(t):
        z = into[i] + h @ back
        gates = _sigmoid(z[:, :3 * hid])
        g = np.tanh(z[:, 3 * hid:])
        before, h_before = c, h
        c = gates[:, hid:2 * hid] * c + gates[:, :hid] * g
        tc = np.tanh(c)
        h = gates[:, 2 * hid:] * tc
        out[i] = h
        if training:
            keep.append((gates, g, before, h_before, tc))
    return out, keep


def _lstm_back(x, w, dout, keep):
    t, n, e = x.shape
    hid = w.shape[1] // 4
    dw, db, dx = np.zeros_like(w), np.zeros(w.shape[1], w.dtype), np.empty_like(x)
    dh, dc = np.zeros((n, hid), w.dtype), np.zeros((n, hid), w.dtype)
    for i in range(t - 1, -1, -1):
        gates, g, before, h_before, tc = keep[i]
        ig, fg, og = gates[:, :hid], gates[:, hid:2 * hid], gates[:, 2 * hid:]
        dh = dh + dout[i]
        dc = dc + dh * og * (1 - tc ** 2)
        dz = np.concatenate([dc * g * ig * (1 - ig), dc * before * fg * (1 - fg), dh * tc * og * (1 - og),
                             dc * ig * (1 - g ** 2)], axis=1)
        dw[:e] += x[i].T @ dz
        dw[e:] += h_before.T @ dz
        db += dz.sum(axis=0)
        dx[i] = dz @ w[:e].T
        dh = dz @ w[e:].T
        dc = dc * fg
    return dw, db, dx


class Tagger:
    """BiLSTM over characters, linear scores, CRF over begin/inside/outside tags."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        u = lambda *s: (r.uniform(-1, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": u(_OTHER + 2, EMBED), "wf": u(EMBED + HIDDEN, 4 * HIDDEN), "wb": u(EMBED + HIDDEN, 4 * HIDDEN),
                  "bf": np.zeros(4 * HIDDEN, np.float32), "bb": np.zeros(4 * HIDDEN, np.float32),
                  "out": u(2 * HIDDEN, _N_TAGS), "bias": np.zeros(_N_TAGS, np.float32),
                  "trans": np.zeros((_N_TAGS, _N_TAGS), np.float32), "start": np.zeros(_N_TAGS, np.float32)}
        for k in ("bf", "bb"):
            self.p[k][HIDDEN:2 * HIDDEN] = 1.0     # remember at first
        self.legal = np.zeros((_N_TAGS, _N_TAGS), np.float32)
        self.legal_start = np.zeros(_N_TAGS, np.float32)
        for k in range(1, len(KINDS) + 1):         # inside follows begin or inside of its kind
            self.legal[:, len(KINDS) + k] = -1e4
            self.legal[[k, len(KINDS) + k], len(KINDS) + k] = 0
            self.legal_start[len(KINDS) + k] = -1e4

    def _scores(self, x, training: bool = True):
        emb = self.p["emb"][x.T]                   # (T, B, E)
        hf, kf = _lstm(emb, self.p["wf"], self.p["bf"], training)
        hb, kb = _lstm(emb[::-1], self.p["wb"], self.p["bb"], training)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        return emb, h, kf, kb, h @ self.p["out"] + self.p["bias"]

    def _marginals(self, s):
        """Posterior of every tag (T, B, K), and what the pairwise sums need: forward and backward
        chances, rescaled at every character so that no length of text overflows, the scores' exponentials,
        the transitions' and the scales."""
        t, n, k = s.shape
        to = np.exp((self.p["trans"] + self.legal).astype(np.float64))
        e = np.exp(s.astype(np.float64) - s.max(axis=2, keepdims=True))
        a, b, scale = np.empty_like(e), np.ones_like(e), np.empty((t, n, 1))
        for i in range(t):
            x = e[0] * np.exp((self.p["start"] + self.legal_start).astype(np.float64)) if i == 0 else (a[i - 1] @ to) * e[i]
            scale[i] = x.sum(axis=1, keepdims=True)
            a[i] = x / scale[i]
        for i in range(t - 2, -1, -1):
            b[i] = (e[i + 1] * b[i + 1] / scale[i + 1]) @ to.T
        return a * b, (a, b, e, to, scale)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 96, rate: float = 0.015) -> None:
        """x, y (rows, WINDOW): character ids and tags; Adam on the CRF's log-loss."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, step = np.random.default_rng(11), 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                at = order[lo:lo + batch]
                g = self._gradient(x[at], y[at])
                step += 1
                for k, grad in g.items():
                    grad = np.clip(grad, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v2[k] = 0.999 * v2[k] + 0.001 * grad ** 2
                    self.p[k] -= (rate * (1 - 0.8 * epoch / epochs) * (m[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def _gradient(self, x, y):
        emb, h, kf, kb, s = self._scores(x)
        post, (a, b, e, to, scale) = self._marginals(s)
        n, gold = x.shape[0], y.T
        one = np.eye(_N_TAGS, dtype=np.float32)[gold]
        ds = ((post - one) / n).astype(np.float32)
        dtr = np.zeros_like(to)
        for i in range(1, len(s)):
            dtr += a[i - 1].T @ (e[i] * b[i] / scale[i])
        dtr *= to / n
        np.add.at(dtr, (gold[:-1].reshape(-1), gold[1:].reshape(-1)), -1.0 / n)
        dtr = dtr.astype(np.float32)
        dh = ds @ self.p["out"].T
        dwf, dbf, dxf = _lstm_back(emb, self.p["wf"], dh[:, :, :HIDDEN], kf)
        dwb, dbb, dxb = _lstm_back(emb[::-1], self.p["wb"], dh[::-1, :, HIDDEN:], kb)
        demb = np.zeros_like(self.p["emb"])
        np.add.at(demb, x.T, dxf + dxb[::-1])
        flat = ds.reshape(-1, _N_TAGS)
        return {"emb": demb, "wf": dwf, "wb": dwb, "bf": dbf, "bb": dbb, "out": h.reshape(-1, 2 * HIDDEN).T @ flat,
                "bias": flat.sum(axis=0), "trans": dtr, "start": ds[0].sum(axis=0)}

    def decode(self, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """(start, end, kind, mean posterior) of the best tag sequence of each window."""
        s = self._scores(x, training=False)[-1]
        post, tr = self._marginals(s)[0], self.p["trans"] + self.legal
        t, n, _ = s.shape
        best, back = s[0] + self.p["start"] + self.legal_start, np.empty((t, n, _N_TAGS), np.int8)
        for i in range(1, t):
            z = best[:, :, None] + tr
            back[i] = z.argmax(axis=1)
            best = s[i] + z.max(axis=1)
        tags = np.empty((n, t), np.int8)
        tags[:, -1] = best.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = back[i][np.arange(n), tags[:, i]]
        out: list = [[] for _ in range(n)]
        for w in np.flatnonzero((tags > 0).any(axis=1)):
            row, i = tags[w].tolist(), 0
            while i < t:
                if 1 <= row[i] <= len(KINDS):
                    kind, j = row[i] - 1, i + 1
                    while j < t and row[j] == len(KINDS) + kind + 1:
                        j += 1
                    p = post[np.arange(i, j), w, row[i:j]].mean()
                    out[w].append((i, j, kind, float(p)))
                    i = j
                else:
                    i += 1
        return out


def _respell(value: str, kind: int, r: random.Random) -> str:
    """The same datum as people also write it."""
    digits = re.sub("[^0-9]", "", value)
    if kind == 0:
        return value.replace("@", r.choice(["@", " at ", " [at] ", "(at)"])).replace(".", r.choice([".", " dot "]))
    if kind == 1 or len(digits) < 10:
        return value
    if kind == 2:
        return r.choice([" ", "-", ".", ""]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    a, b, c = local[:3], local[3:6], local[6:]
    return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"00{digits[:-10]} {a} {b} {c}"])


def _other(value: str, kind: int, r: random.Random) -> str:
    """A datum of the same shape: other letters and digits, but for well-known endings."""
    tail = re.search(r"\.[A-Za-z]{2,4}\Z", value)
    keep = tail.start() if tail else len(value)
    new = lambda c: r.choice("abcdefghijklmnopqrstuvwxyz") if c.isascii() and c.isalpha() else r.choice("0123456789") if c in "0123456789" else c
    out = "".join(new(c) for c in value[:keep]) + value[keep:]
    return next((out[:-1] + c for c in "0123456789" if luhn(re.sub("[^0-9]", "", out[:-1] + c))), out) if kind == 2 else out


def _address(r: random.Random) -> str:
    """An e-mail address of another shape: one to three parts of a name, a host of one or two."""
    word = lambda lo, hi: "".join(r.choice("bcdfghjklmnprstvwz") if i % 2 == r.randrange(9) // 8 else r.choice("aeiou") for i in range(r.randrange(lo, hi)))
    name = r.choice([".", "_", "-", ""]).join(word(2, 9) for _ in range(r.choice((1, 1, 2, 2, 3)))) + r.choice(["", "", str(r.randrange(2000))])
    host = ".".join(word(3, 9) + r.choice(["", "", "", str(r.randrange(10))]) for _ in range(r.choice((1, 1, 2))))
    return f"{name}@{host}.{r.choice(('com', 'org', 'net', 'de', 'fr', 'es', 'io', 'edu', 'co.uk'))}"


#: Text about an at, a dot or numbers that are no such datum; ``#`` stands for a digit.
_DECOYS = (" at ## ", " look at the dot ", " version #.#.## ", " in #### and #### ", " ###,###.## ", " #### ", " ##.##.#### ", " at home ", " ##:## ",
           " nr ###### ", " ###-### ", " dot dot ", " ##########################", " #### #### ", " id ######## ", " (at) ", " #.## ")


def examples(texts: list[str], seed: int = 3, copies: int = COPIES) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of labelled texts.

    All windows of the texts that hold a span or an anchor, as they are; and for every span ``copies`` windows
    of its text around it in which the span is respelled, of other letters and digits,
    at a place of its own, beside words or a decoy.
    """
    r, xs, ys = random.Random(seed), [], []

    def add(text: str, tags: list[int]) -> None:
        x, y = np.zeros(LEARNT, np.uint8), np.zeros(LEARNT, np.int64)
        ids = encode(text[:LEARNT])
        x[:len(ids)], y[:len(ids)] = ids, tags[:LEARNT]
        if y[0] > len(KINDS):                      # a span cut by the window's edge begins there
            y[0] -= len(KINDS)
        xs.append(x)
        ys.append(y)

    mark = lambda kind, value: [1 + kind] + [1 + len(KINDS) + kind] * (len(value) - 1)
    for text in texts:
        spans, tags = base_spans(text), [0] * len(text)
        for start, kind, end in spans:
            if not any(tags[start:end]):
                tags[start:end] = mark(kind, text[start:end])
        hot = {i for i, t in enumerate(tags) if t} | {m.start() for m in _ANCHOR.finditer(text)}
        for w in sorted({i // LEARNT for i in hot}):
            lo = max(0, w * LEARNT - r.randrange(LEARNT // 2))
            add(text[lo:lo + LEARNT], tags[lo:lo + LEARNT])
        for start, kind, end in spans:
            for _ in range(copies):
                value = text[start:end] if r.random() < 0.2 else _other(text[start:end], kind, r)
                value = _address(r) if kind == 0 and r.random() < 0.5 else value
                value = _respell(value, kind, r)
                room = max(0, LEARNT - len(value))
                lead = r.randrange(room + 1)
                before, after = text[max(0, start - lead):start], text[end:end + room]
                if r.random() < 0.5:               # words from elsewhere in the text
                    at = r.randrange(len(text))
                    before, after = (text[at:at + lead].split(" ", 1)[-1] + " ")[-lead:] if lead else "", " " + text[at:at + room]
                if r.random() < 0.4:
                    decoy = re.sub("#", lambda m: str(r.randrange(10)), r.choice(_DECOYS))
                    before, after = (before + decoy, after) if r.random() < 0.5 else (before, decoy + after)
                cut = max(0, len(before) + len(value) - LEARNT)
                add((before + value + after)[cut:], ([0] * len(before) + mark(kind, value) + [0] * len(after))[cut:])
    return (np.array(xs, np.uint8), np.array(ys)) if xs else (np.zeros((0, LEARNT), np.uint8), np.zeros((0, LEARNT), np.int64))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """A tagger trained on at most ``sample_rows`` texts of 20,000 bytes or less that
    hold a pattern (those whose ids hash lowest; of rows that share one, the least text).  Without any, it adds nothing."""
    some = F.col(text_col).rlike(r"[0-9]{3}|@[A-Za-z0-9-]+\.") & (F.octet_length(text_col) <= 20_000)
    held = docs.where(some & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    chosen = held.select("i").distinct().orderBy(F.xxhash64("i"), "i").limit(sample_rows)       # at most sample_rows ids
    rows = held.join(F.broadcast(chosen), "i").groupBy("i").agg(F.min("t").alias("t")).orderBy("i").collect()
    x, y = examples([r["t"] for r in rows])
    tagger = Tagger()
    if (y > 0).any():
        tagger.train(x, y)
    else:
        tagger.p["bias"][0] = 50.0
    return tagger


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """The subset without overlaps that has the greatest sum of scores (posterior
    times length); equal sums keep the earlier spans.  (start, kind, end) by start."""
    import bisect

    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in spans]
    best, take = [0.0], []
    for i, (a, b, _, p) in enumerate(spans):
        j = bisect.bisect_right(ends, a, 0, i)
        with_ = best[j] + p * (b - a)
        take.append((with_ > best[i] + 1e-9, j))
        best.append(max(best[i], with_))
    out, i = [], len(spans)
    while i:
        chosen, j = take[i - 1]
        if chosen:
            a, b, kind, _ = spans[i - 1]
            out.append((a, kind, b))
            i = j
        else:
            i -= 1
    return sorted(out)


def _open_windows(text: str, base: list[tuple[int, int, int]]) -> list[int]:
    """Window numbers that hold an anchor no base span covers: any span without an
    overlap that holds one lies within one of them or has ``STRIDE`` characters there."""
    found, k, reach = set(), 0, -1
    for m in _ANCHOR.finditer(text):
        at = m.start()
        while k < len(base) and base[k][0] <= at:
            reach = max(reach, base[k][2])
            k += 1
        if at >= reach:
            w = at // STRIDE
            found.update((w - 1, w) if w else (w,))
    return sorted(found)


class Finder:
    """Base and added spans of texts; windows of many texts are tagged together."""

    def __init__(self, tagger: Tagger):
        self.tagger = tagger

    def spans(self, texts: list[str | None]) -> list[tuple[list, list]]:
        """(base, all) spans of each text as (start, kind, end); null: none."""
        base = [base_spans(t) if t and _ANCHOR.search(t) else [] for t in texts]
        where, windows = [], []
        added: list[list] = [[] for _ in texts]
        for i, t in enumerate(texts):
            if not t or not (at := _open_windows(t, base[i])):
                continue
            for w in at:
                piece = encode(t[w * STRIDE:w * STRIDE + WINDOW])
                x = np.zeros(WINDOW, np.uint8)
                x[:len(piece)] = piece
                windows.append(x)
                where.append((i, w * STRIDE))
            if len(windows) >= 1024:
                self._tag(texts, where, windows, added)
                where, windows = [], []
        if windows:
            self._tag(texts, where, windows, added)
        out = []
        for t, b, a in zip(texts, base, added, strict=True):
            free = [s for s in a if all(s[1] <= x or s[0] >= y for x, _, y in b)]
            out.append((b, sorted(b + reconcile(free)) if free else b))
        return out

    def _tag(self, texts, where, windows, added, width: int = WINDOW) -> None:
        unique, back = np.unique(np.array(windows), axis=0, return_inverse=True)
        step = max(1, 1024 * WINDOW // width)
        found = [s for lo in range(0, len(unique), step) for s in self.tagger.decode(unique[lo:lo + step])]
        cut = set()
        for (i, lo), u in zip(where, back.reshape(-1), strict=True):
            n = len(texts[i])
            for a, b, kind, p in found[u]:
                a, b = a + lo, min(b + lo, n)
                if (a == lo and lo) or (b >= lo + width and lo + width < n):
                    if b - a >= STRIDE and width <= 2 * MAX_SPAN:      # else another window sees it whole, or it is too long
                        cut.add((i, max(0, (lo // (width // 2) - 1) * (width // 2))))
                    continue
                value = texts[i][a:b]
                # an address whose host has no dot must be surer
                sure = MIN_POSTERIOR if kind or _DOT.search(value) else SURE_POSTERIOR
                if p >= sure and plausible(value, kind):
                    added[i].append((a, b, kind, round(p, 6)))
        wider = sorted(cut)
        for k in range(0, len(wider), step):
            x = np.zeros((len(wider[k:k + step]), 2 * width), np.uint8)
            for row, (i, lo) in zip(x, wider[k:k + step], strict=True):
                piece = encode(texts[i][lo:lo + 2 * width])
                row[:len(piece)] = piece
            self._tag(texts, wider[k:k + step], x, added, 2 * width)


def plausible(value: str, kind: int) -> bool:
    """What the tagger marks must still be able to be such a datum."""
    digits = sum(c in "0123456789" for c in value)
    if value != value.strip() or len(value) > MAX_SPAN:
        return False
    if kind == 0:
        return len(value) >= 6 and re.search(_AT, value) is not None
    if kind == 1:
        return digits >= 4 and len(re.findall("[0-9]+", value)) == 4
    rest = sum(c not in "0123456789 ().+-" for c in value)
    if kind == 2:
        return rest == 0 and 13 <= digits <= 19 and luhn(re.sub("[^0-9]", "", value))
    return rest == 0 and 9 <= digits <= 15


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{LABELS[k]}:{a}:{b}" for a, k, b in spans)


def find_personal(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id``, counts of base spans by kind, ``base_sha256`` and ``spans``; then ``n_added``
    (spans that the tagger adds), ``n_secret`` and ``secrets`` (apart from ``spans``), ``n_found`` (all of these).

    Null and empty texts have no spans (the digest of the empty string).  Repeated
    rows give repeated results.  Spans of different kinds may overlap; added
    spans overlap nothing.
    """
    def run(batches):
        forget_in_worker()
        finder = Finder(tagger)
        for b in batches:
            texts = b.column(1).to_pylist()
            got, secrets = finder.spans(texts), [secret_spans(t) for t in texts]
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in got] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in got], pa.string()),
                 pa.array([joined(s) for _, s in got], pa.string()),
                 pa.array([len(s) - len(base) for base, s in got], pa.int64()),
                 pa.array([len(s) for s in secrets], pa.int64()), pa.array([joined(s) for s in secrets], pa.string()),
                 pa.array([len(s) + len(x) for (_, s), x in zip(got, secrets, strict=True)], pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_secret", "secrets", "n_found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long, "
        "n_secret long, secrets string, n_found long")


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; spans that
    overlap are replaced as one, by the kind of the first."""
    out, last, end = [], 0, -1
    for a, kind, b in spans:
        if a >= end:
            out += [text[last:a], f"[{LABELS[kind].upper()}]"]
            last = end = b
        elif b > end:
            last = end = b
    return "".join(out) + text[last:]


def redact(docs: DataFrame, tagger: Tagger, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with personal data and secrets in the text replaced; the length
    column (where there is one) follows the new text.  Null texts stay null."""
    names = docs.columns

    def run(batches):
        forget_in_worker()
        finder = Finder(tagger)
        for b in batches:
            at = b.schema.get_field_index(text_col)
            texts = b.column(at).to_pylist()
            new = []
            for t, (_, s) in zip(texts, finder.spans(texts), strict=True):
                s = sorted(s + secret_spans(t))
                new.append(redact_text(t, s) if s else t)
            columns = list(b.columns)
            columns[at] = pa.array(new, pa.string())
            if length_col in names:
                i = b.schema.get_field_index(length_col)
                columns[i] = pa.array([n if new[k] is texts[k] else len(new[k]) for k, n in
                                       enumerate(columns[i].to_pylist())], columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
