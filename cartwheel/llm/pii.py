"""Personal data: exact patterns, and a linear-chain CRF that adds what they miss.

The patterns find well-formed emails, IP addresses, card and phone numbers in
every text. The conditional random field labels the words around digits and
``@`` signs by word-shape features, and adds spans whose shape speaks for a
kind though the pattern's check refused it, such as a number with a mistyped
digit, and secrets: long random values that a name such as ``token`` or
``api_key`` introduces. It is trained on a small labelled table and decoded by Viterbi in numpy,
many windows of words at a time. Words with neither a digit nor an ``@`` are
outside every span by rule; the two of them on each side of a candidate are
its context.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: What the field finds: the patterns' kinds, then secrets.
ALL_KINDS = (*KINDS, "secret")
LABELS = ("O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone", "B-secret")
CONTEXT = 2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\t-\r]+")
_MARK = re.compile(r"[0-9@]")
#: A word with a mark; the look-behind lets each word be tried from its beginning only.
_MARKED = re.compile(r"(?<![^\x20\t-\r])[^\x20\t-\r0-9@]*+[0-9@][^\x20\t-\r]*+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Well-formed personal data: leftmost matches of each kind that pass its check, sorted."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = [int(c) for c in m[0] if c in "0123456789"] if m.end() - m.start() < 64 else []
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Emails from their ``@``: the local part reaches back, the domain ahead; each letter is read once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: list[int]) -> bool:
    double = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(double)) % 10 == 0


def find_personal_data(docs: DataFrame, model: CRF | None = None) -> DataFrame:
    """Spans of personal data in every whole text of ``docs(doc_id, text)``.

    Returns, for each input row, ``doc_id, base array<struct<kind, start,
    end>>`` (the patterns' spans) and ``added`` (the CRF's, none overlapping a
    pattern's), in code points, end exclusive, sorted by start, then kind in
    the order of ``ALL_KINDS``. Null and empty texts have none; repeated rows
    repeat; an empty table gives an empty table. The CRF is fitted here, on
    :func:`labelled_table`, unless given.
    """
    model = model or CRF.fit(labelled_table())
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_find(model), f"doc_id bigint, base {span}, added {span}")


def _find(model: CRF):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(lo, 512).to_pylist()
                base = [base_spans(t) if _MARK.search(t) else [] for t in texts]
                added = model.spans(texts, base)
                columns = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in y], kind) for y in (base, added)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), *columns], ["doc_id", "base", "added"])

    return run


def digest(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


# --- the labelled table -----------------------------------------------------------------------


def labelled_table(rows: int = 640, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Short word sequences with a label for each word, built by rule.

    Half of them hold one piece of personal data or a secret among invented
    words, half hold numbers that are none: years, prices, versions, times,
    counts, and hashes that no name of a secret introduces.
    """
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[int(rng.integers(len(options)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = "aeioubcdfghjklmnprstvwéèñóüßçà"

    def word(plain: bool = False) -> str:
        w = "".join(letters[i] for i in rng.integers(0, 20 if plain else len(letters), int(rng.integers(1, 11))))
        return w if plain else pick(w, w, w, w.capitalize(), w.upper()) + pick("", "", "", "", ",", ".", ":", ")")

    def value() -> str:
        """A long random value: hexadecimal, base 64, or letters and digits after a short prefix."""
        raw = rng.bytes(int(rng.integers(12, 33)))
        b64 = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[x % 64] for x in rng.bytes(int(rng.integers(20, 45)))) + digits(1)
        return pick(raw.hex(), raw.hex(), raw.hex().upper(), b64, b64 + "=", pick("sk_live_", "ghp_", "AKIA", "xox-") + raw.hex()[:24])

    mark = lambda: pick("", "", "", "", ".", ",", ";", "!!", "###", "***", "$$$")
    out = []
    for i in range(rows):
        make = i % 20
        if make in (0, 1):
            own = [(f"{word(True)}.{digits(2)}@mail{digits(1)}.example.com", "B-email")]
        elif make == 2:
            own = [(f"{word(True)}@{word(True)}.{pick('org', 'net', 'de')}", "B-email")]
        elif make in (3, 4):
            own = [(".".join(str(x) for x in rng.integers(0, 256, 4)), "B-ip")]
        elif make == 5:
            own = [(digits(16), "B-card")]
        elif make == 6:
            own = [(digits(4), "B-card" if k == 0 else "I-card") for k in range(4)]
        elif make in (7, 8):
            own = [("+" + digits(1), "B-phone"), (f"({digits(3)})", "I-phone"), (f"{digits(3)}-{digits(4)}", "I-phone")]
        elif make == 9:
            own = [("+" + digits(2), "B-phone"), (digits(3), "I-phone"), (digits(3), "I-phone"), (digits(4), "I-phone")]
        elif make in (10, 11, 12):
            name = pick("", "", "my_", "db_", "x-") + pick("token", "secret", "password", "api_key", "apikey", "access_key", "passwd", "auth_token", "client_secret")
            name, quote = pick(name, name.upper(), name.capitalize()), pick('"', '"', "'", "")
            held, sign = quote + value() + quote, pick("=", "=", ":", ":=", "=>")
            own = pick([(name, "O"), (sign, "O"), (held, "B-secret")], [(name, "O"), (sign, "O"), (held, "B-secret")], [(name + pick(":", "="), "O"), (held, "B-secret")], [(name + pick("=", ":") + held, "B-secret")])
        elif make == 13:
            own = [(pick("commit", "sha256", "md5", "rev", "id", "hash", "build", "etag"), "O"), *pick([], [(pick("=", ":"), "O")]), (pick("", '"') + rng.bytes(20).hex() + pick("", '"'), "O")]
        else:
            odd = [digits(4), "3.", digits(2) + "." + digits(2), "v" + digits(1) + "." + digits(1) + "." + digits(1), digits(2) + ":" + digits(2), "20" + digits(2) + "-" + digits(2) + "-" + digits(2)]
            odd += ['"' + rng.bytes(20).hex() + '"', digits(1) + "," + digits(3), digits(7), "a" + digits(2) + "b", "2.0", digits(5), "@" + word(), digits(3) + "-" + digits(4), digits(25), digits(2) + "%", "x=" + digits(2)]
            own = [(pick(*odd), "O") for _ in range(int(rng.integers(1, 4)))]
        if own[-1][1] != "O":
            own[-1] = (own[-1][0] + mark(), own[-1][1])
        before, after = ([(word(), "O") for _ in range(int(rng.integers(1, 4)))] for _ in range(2))
        words = before + own + after
        out.append(([w for w, _ in words], [x for _, x in words]))
    return out


# --- the field ----------------------------------------------------------------------------------


def word_features(word: str) -> tuple[str, ...]:
    """Shape features of one word: its run shape, its digits, its marks."""
    core = word.strip(".,;:!?#$%&*|<>\"'()[]") or word
    runs = re.sub(r"[^\W\d_]+", "x", re.sub(r"[0-9]+", "d", core))
    n = sum(c in "0123456789" for c in core)
    value = _value(word)
    random = len(value) >= 20 and _RANDOM.fullmatch(value) is not None and n > 0
    named = _NAMED.match(word) is not None
    return (
        # A long mixture of letters and digits has a shape of its own each time.
        "shape=" + ("random" if random else runs),
        f"named={named}{random}",
        f"digits={min(n, 20)}",
        f"at={'@' in core}",
        f"plus={word.startswith('+')}",
        f"paren={word.startswith('(') and n > 0}",
        f"quads={core.count('.') == 3 and n > 3}",
        f"letters={any(c.isalpha() for c in core)}",
        f"marked={n > 0 or '@' in core}",
    )


#: Names that introduce a secret, alone or before a value.
_NAMED = re.compile(r"[\"'(\[]?[\w.-]*(?:token|secret|passw|api_?key|access_?key|auth)[\w.-]*(?![\w.-])", re.IGNORECASE)
#: Letters of hexadecimal, base 64 and prefixed values.
_RANDOM = re.compile(r"[A-Za-z0-9+/_-]+=*")
_SIGNS = frozenset(("=", ":", ":=", "=>"))


def _value(word: str) -> str:
    """What a word assigns, or the word itself, without quotes and marks around."""
    name = _NAMED.match(word)
    rest = word[name.end() :].lstrip(":=>") if name and word[name.end() : name.end() + 1] in (":", "=") else word
    return rest.strip(".,;:!?#$%&*|<>\"'()[]")


class CRF:
    """A linear-chain conditional random field; weights are numpy arrays."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    @classmethod
    def fit(cls, table: list[tuple[list[str], list[str]]], steps: int = 150, rate: float = 0.3, decay: float = 1e-3) -> CRF:
        """Maximum likelihood by AdaGrad over the whole table; forward-backward runs on all rows at once."""
        index: dict[str, int] = {}
        for words, _ in table:
            for f in cls._features(words):
                for x in f:
                    index.setdefault(x, len(index))
        k, longest = len(LABELS), max(len(w) for w, _ in table)
        design = np.zeros((len(table), longest, len(index)))
        gold = np.zeros((len(table), longest, k))
        live = np.zeros((len(table), longest), bool)
        for i, (words, labels) in enumerate(table):
            for t, f in enumerate(cls._features(words)):
                design[i, t, [index[x] for x in f]] = 1
                gold[i, t, LABELS.index(labels[t])] = 1
                live[i, t] = True
        pairs = np.einsum("ntj,ntk->jk", gold[:, :-1], gold[:, 1:])
        flat = design.reshape(-1, len(index))
        emit, move = np.zeros((len(index), k)), np.zeros((k, k))
        sums = [np.full_like(emit, 1e-8), np.full_like(move, 1e-8)]
        for _ in range(steps):
            score = design @ emit
            node, edge = cls._marginals(score, move, live)
            grads = [flat.T @ (gold - node).reshape(len(flat), k) - decay * len(table) * emit, pairs - edge - decay * len(table) * move]
            for w, g, s in zip((emit, move), grads, sums, strict=True):
                s += g * g
                w += rate * g / np.sqrt(s)
        # A span never begins with an inner label.
        for inner, kind in (("I-card", "card"), ("I-phone", "phone")):
            for j, label in enumerate(LABELS):
                if not label.endswith(kind):
                    move[j, LABELS.index(inner)] = -1e4
        return cls(index, emit, move)

    @staticmethod
    def _features(words: list[str]) -> Iterator[list[str]]:
        """Features of one word after the other: its own, some of the word before and of the word after.

        A sign such as ``=`` passes on whether a name of a secret stands before it.
        """
        before, own, passed = None, word_features(words[0]) if words else None, False
        for t in range(len(words)):
            after = word_features(words[t + 1]) if t + 1 < len(words) else None
            around = [f"p:{x}" for x in before[:5]] if before else ["p:none"]
            around += [f"n:{x}" for x in after[:3]] if after else ["n:none"]
            around.append(f"introduced={passed}{own[1].endswith('True')}")
            yield [*own, *around]
            named = own[1] == "named=TrueFalse"
            passed = named or (passed and words[t] in _SIGNS)
            before, own = own, after

    @staticmethod
    def _marginals(score: np.ndarray, move: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, longest, k = score.shape
        sum_exp = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
        ahead = np.zeros((n, longest, k))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            step = sum_exp(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        total = sum_exp(ahead[:, -1], 1)
        back = np.zeros((n, longest, k))
        edge = np.zeros((k, k))
        for t in range(longest - 2, -1, -1):
            joined = move + (score[:, t + 1] + back[:, t + 1])[:, None, :]
            back[:, t] = np.where(live[:, t + 1, None], sum_exp(joined, 2), 0)
            both = np.exp(ahead[:, t, :, None] + joined - total[:, None, None])
            edge += both[live[:, t + 1]].sum(axis=0)
        return np.exp(ahead + back - total[:, None, None]) * live[:, :, None], edge

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of many windows at once; ``scores`` is padded to (windows, longest, labels)."""
        n, longest, k = scores.shape
        best = scores[:, 0].copy()
        best[:, [LABELS.index("I-card"), LABELS.index("I-phone")]] = -1e4
        back = np.zeros((n, longest, k), np.int8)
        for t in range(1, longest):
            step = best[:, :, None] + self.move
            back[:, t] = step.argmax(axis=1)
            best = np.where((t < lengths)[:, None], step.max(axis=1) + scores[:, t], best)
        out = np.zeros((n, longest), np.int8)
        label = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            inside = t < lengths
            out[inside, t] = label[inside]
            label = np.where(inside & (t > 0), back[np.arange(n), t, label], label)
        return out

    def emissions(self, windows: list[list[str]]) -> list[np.ndarray]:
        """Scores of every word of every window; words share rows of the weights by their features."""
        memory: dict[tuple, np.ndarray] = {}
        out = []
        for words in windows:
            rows = []
            for f in self._features(words):
                key = tuple(f)
                if key not in memory:
                    memory[key] = self.emit[[self.index[x] for x in f if x in self.index]].sum(axis=0)
                rows.append(memory[key])
            out.append(np.stack(rows))
        return out

    def decode(self, windows: list[list[str]]) -> list[np.ndarray]:
        """Viterbi over windows of like length together, so one long window pads no others."""
        scores = self.emissions(windows)
        lengths = np.array([len(s) for s in scores], dtype=np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(windows)
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = max(2 * lengths[order[at]], 8)
            end = min(int(np.searchsorted(lengths[order], longest, side="right")), at + max(1, 400_000 // int(longest)))
            part = order[at:end]
            m = np.zeros((len(part), int(lengths[part].max()), len(LABELS)))
            for r, i in enumerate(part):
                m[r, : lengths[i]] = scores[i]
            for r, labels in enumerate(self.viterbi(m, lengths[part])):
                out[part[r]] = labels[: lengths[part[r]]]
            at = end
        return out

    def spans(self, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
        """The field's spans of each text that overlap none of ``base``."""
        owner, windows = [], []
        for i, text in enumerate(texts):
            for window in _windows(text):
                owner.append(i)
                windows.append(window)
        labels = self.decode([[w for w, _ in window] for window in windows])
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for i, window, own in zip(owner, windows, labels, strict=True):
            for kind, first, last in _chunks([LABELS[x] for x in own]):
                if not any(_MARK.search(w) for w, _ in window[first : last + 1]):
                    continue
                start = window[first][1]
                word, at = window[last]
                core = word.rstrip(".,;:!?#$%&*|<>\"'()[]") or word
                lead = len(window[first][0]) - len(window[first][0].lstrip("\"'[<|#$%&*(" if kind != "phone" else "\"'[<|#$%&*"))
                span = (kind, start + lead, at + len(core))
                if kind == "secret":
                    value = _value(word)
                    begin = at + word.rindex(value)
                    span = (kind, begin, begin + len(value))
                if span[1] < span[2] and not any(s < span[2] and span[1] < e for _, s, e in base[i]):
                    out[i].append(span)
        return [sorted(set(x), key=lambda s: (s[1], ALL_KINDS.index(s[0]), s[2])) for x in out]


def _windows(text: str) -> list[list[tuple[str, int]]]:
    """Runs of words with a digit or ``@``, and ``CONTEXT`` words around; runs that touch are one.

    Runs touch if at most ``2 * CONTEXT`` words lie between. Of a longer gap
    only the words at both ends are read, however long it is.
    """
    windows, done = [], 0
    for m in _MARKED.finditer(text):
        gap = _first_words(text, done, m.start(), 2 * CONTEXT + 1)
        if windows and len(gap) <= 2 * CONTEXT:
            windows[-1] += gap
        else:
            if windows:
                windows[-1] += gap[:CONTEXT]
            windows.append(_last_words(text, done, m.start(), CONTEXT))
        windows[-1].append((m[0], m.start()))
        done = m.end()
    if windows:
        windows[-1] += _first_words(text, done, len(text), CONTEXT)
    return windows


def _first_words(text: str, start: int, end: int, n: int) -> list[tuple[str, int]]:
    return [(m[0], m.start()) for m in islice(_WORD.finditer(text, start, end), n)]


def _last_words(text: str, start: int, end: int, n: int) -> list[tuple[str, int]]:
    """The last ``n`` words of ``text[start:end]``, from ever longer pieces of its end."""
    size = 64
    while True:
        at = max(start, end - size)
        found = [(m[0], m.start()) for m in _WORD.finditer(text, at, end)]
        if at == start or len(found) > n:  # the first word of a piece may have begun before it
            return found[-n:]
        size *= 4


def _chunks(labels: list[str]) -> Iterator[tuple[str, int, int]]:
    first = None
    for t, label in enumerate([*labels, "O"]):
        if first is not None and not label.startswith("I-"):
            yield labels[first][2:], first, t - 1
            first = None
        if label.startswith("B-"):
            first = t


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
