"""Personal data by rules and a semi-Markov conditional random field.

Base spans come from four patterns (e-mail, IP, card, phone) over whole texts.
A semi-Markov CRF adds spans that the patterns miss (other ways of writing the
same things): it scores whole candidate segments, not single tokens, by features
of the span (shape, digits, length, Luhn and range tests, the words before it),
and one dynamic program over a region chooses boundaries and types jointly, with
segments of at most ``MOST_TOKENS`` tokens. Regions are the neighbourhoods of
tokens with a digit, an at sign or a spelt-out sign (``at``, ``[at]``, ``(at)``,
``dot``, ``[dot]``, ``(dot)``), however long; only those of the training sample are
cut, after ``LONGEST_REGION`` tokens. Features and scores are held for ``BLOCK_TOKENS``
tokens at a time, so a long text full of numbers costs little more memory than its tokens.

Training is log-likelihood over segmentations (forward-backward) on at most
``TRAIN_REGIONS`` regions with base spans and as many without, the smallest of each
by hash over the whole corpus, labelled by the base patterns. Every region with base
spans comes as it is and in the looser spellings the model is to learn (phones
without plus sign or grouped as elsewhere, cards with dots, slashes or wide gaps,
spelt-out at signs and dots), labels kept; half
of the regions without get dates, times, versions, amounts, long numbers that are no
cards, and stray signs, so the model also sees what is none. The same regions come
again with one made-up span each, of any kind and in a looser spelling. Regions of more
than 2,000 characters are not drawn for training. Bare groups of digits (a number with
its country code and nothing else to tell it from a list of numbers) are not learnt. A model span counts if its marginal probability is
at least ``SURE`` and it touches no base span; base spans always stay.

Nulls and odd rows: a null text counts as empty; null and repeated doc_ids keep
their rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import turn_to

KINDS = ("email", "ip", "card", "phone")
TRAIN_REGIONS = 400
ROUNDS = 30
SURE = 0.97
MOST_TOKENS = 7
CONTEXT = 3
LONGEST_REGION = 48
BLOCK_TOKENS = 4096

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never starts behind a digit or gives digits back, so saying so changes none and keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
HOT = re.compile(r"[0-9@]")
# What opens a region: also a spelt-out sign, bare ones as tokens of their own.
OPENS = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]|(?<![^\x20\x09-\x0D])(?:at|dot)(?![^\x20\x09-\x0D])", re.IGNORECASE | re.ASCII)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, found from the at signs: the local part before one cannot hold another."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15] if "+" in text else []
    return out


def regions(text: str, longest: float = math.inf) -> list[list[tuple[int, int]]]:
    """Token spans of the whole stretches around tokens with a digit, an at sign or a spelt-out sign, or cut after ``longest`` tokens."""
    tokens = [m.span() for m in TOKEN.finditer(text)]
    hot = [i for i, (a, b) in enumerate(tokens) if OPENS.search(text, a, b)]
    out: list[list[int]] = []
    for i in hot:
        a, b = max(0, i - CONTEXT), min(len(tokens), i + CONTEXT + 1)
        if out and a <= out[-1][1] and b - out[-1][0] <= longest:
            out[-1][1] = b
        else:
            out.append([max(a, out[-1][1]) if out else a, b])
    return [tokens[a:b] for a, b in out if b > a]


# How an e-mail looks as a whole, its signs spelt out or not.
MAIL_FORM = re.compile(r"[A-Za-z0-9._%+-]+(?: ?(\[at\]|\(at\)) ?| (at) |(@))[A-Za-z0-9-]+(?:(?:\.| dot | ?\[dot\] ?| ?\(dot\) ?)[A-Za-z0-9-]+)*(\.| dot | ?\[dot\] ?| ?\(dot\) ?)([A-Za-z]{2,})", re.IGNORECASE | re.ASCII)

# Common endings of host names.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "eu", "uk", "de", "fr", "es", "it", "nl", "ch", "at", "vn")
# How a phone number looks as a whole: groups of digits after an optional prefix.
CALL_FORM = re.compile(r"(?:\+|00)?(?:[0-9]{1,3}[ -]+)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ -]+[0-9]{2,7}){1,4}")

# A dot of an IP, spelt out or not.
OCTET_DOT = re.compile(r" ?(?:\[\.\]|\(\.\)|[\[(]dot[\])]) ?| dot |\.", re.IGNORECASE | re.ASCII)

TRIM = ".,;:!?\"'()[]<>"


def core(text: str, a: int, b: int) -> tuple[int, int]:
    """The segment without punctuation around it (a bracket that opens a number stays)."""
    while b > a and text[b - 1] in TRIM:
        b -= 1
    while a < b and text[a] in TRIM and not (text[a] == "(" and ")" in text[a:b]):
        a += 1
    return a, b


def features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Whole-span features of tokens i..j-1."""
    a, b = core(text, tokens[i][0], tokens[j - 1][1])
    span = text[a:b]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", span)))
    runs = re.sub(r"9+", "9", shape)
    digits = digits_of(span)
    n = len(digits)
    parts = span.split(".")
    octets = OCTET_DOT.split(span) if n < 13 and 4 <= n else []
    spelt = len(octets) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in octets)
    # only numbers of a phone's or a card's length have sizes of groups worth telling apart
    sizes = "-".join(str(len(g)) for g in re.findall(r"[0-9]+", span)) if 9 <= n <= 19 and not any(c.isalpha() for c in span) else ""
    mail = MAIL_FORM.fullmatch(span)
    form = "none" if not mail else f"{'square' if mail[1] else 'word' if mail[2] else '@'}&{mail[4].strip()}&{mail[5].lower() in ENDINGS}"
    return [
        "bias", f"tokens={j - i}", f"shape={runs}", f"digits={n if n < 20 else 20}", f"plus={span[:1] == '+'}",
        f"at={span.count('@') if span.count('@') < 2 else 2}", f"mail={mail is not None and mail[5].lower() in ENDINGS}", f"form={form}", f"call={9 <= n <= 15 and CALL_FORM.fullmatch(span) is not None}",
        f"phone={9 <= n <= 15}&{set(span) <= set('0123456789+() .-')}&{j - i}", f"card={13 <= n <= 19 and luhn(digits)}&{13 <= n <= 19}&{set(span) <= set('0123456789 -')}",
        f"pan={13 <= n <= 19 and luhn(digits) and set(span) <= set('0123456789 -./')}", f"sizes={sizes}", f"lead={digits[:2] if sizes else ''}", f"spelt={spelt}&{j - i}",
        f"ip={len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}&{len(parts) == 4}", f"letters={any(c.isalpha() for c in span)}&{n > 0}",
        f"edges={HOT.search(text, *tokens[i]) is not None}&{HOT.search(text, *tokens[j - 1]) is not None}", f"before={before(text, tokens, i)}",
    ]


def before(text: str, tokens: list[tuple[int, int]], i: int) -> str:
    """What stands before token i: the region's start, a spelt-out sign, or whether it holds a digit or an at sign."""
    if not i:
        return "False"
    a, b = tokens[i - 1]
    word = text[a:b].lower() if b - a <= 5 else ""
    return word if word in ("at", "dot", "[at]", "(at)", "[dot]") else str(HOT.search(text, a, b) is not None)


LETTERS = re.compile(r"[A-Za-z]+|[^\W\d_]+")
MOST_BLANK = 100_000


def outline(part: str) -> str:
    """A region without digits and at signs, as far as the features see it: its letters are told apart no further."""

    def form(m: re.Match) -> str:
        run = m[0].lower()
        if not run.isascii():
            return "é"
        return run if run in ("at", "dot") or run in ENDINGS else "aa" if len(run) > 1 else "a"

    return LETTERS.sub(form, part)


class SemiCRF:
    """Weights per feature (row) and label; label 0 is a single token of ordinary text.

    Regions opened by a spelt-out sign alone mostly have one of few outlines; those
    in which nothing was found are remembered and not scored again.
    """

    def __init__(self, names: list[str] | None = None, weights: np.ndarray | None = None) -> None:
        self.ids = {x: i for i, x in enumerate(names or [])}
        self.w = np.zeros((len(self.ids) + 1, len(KINDS) + 1)) if weights is None else weights  # the last row: features never seen
        self.blank: set[str] = set()

    def scored(self, text: str, tokens: list[tuple[int, int]], after: int, upto: int) -> tuple[list[tuple[int, int]], np.ndarray]:
        """The segments that end after token ``after`` and by ``upto``, by end, and their scores; names of features are not kept."""
        segments = ends(after, upto)
        none = len(self.ids)
        rows = np.fromiter((self.ids.get(x, none) for i, j in segments for x in features(text, tokens, i, j)), np.int32)
        return segments, self.scores(segments, rows.reshape(len(segments), -1))

    def lattice(self, text: str, tokens: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[list[str]]]:
        """All segments (i, j) by end, and their features."""
        segments = ends(0, len(tokens))
        return segments, [features(text, tokens, i, j) for i, j in segments]

    def rows(self, names: list[list[str]]) -> np.ndarray:
        return np.array([[self.ids.get(x, len(self.ids)) for x in f] for f in names], np.int64)

    def scores(self, segments: list[tuple[int, int]], rows: np.ndarray) -> np.ndarray:
        """The score of each (segment, label); only single tokens can be ordinary text."""
        out = np.zeros((len(rows), self.w.shape[1]))
        for column in rows.T:  # one feature at a time: a long region's weights are not all held at once
            out += self.w[column]
        first, last = np.array(segments).T
        out[last - first > 1, 0] = -np.inf
        return out

    def marginals(self, segments: list[tuple[int, int]], rows: np.ndarray) -> np.ndarray:
        """The probability of each (segment, label), by a bounded dynamic program each way."""
        scores = self.scores(segments, rows)
        total, n = _log_sums(scores), segments[-1][1]
        ahead, back = _outside(n)
        for (i, j), t in zip(segments, total):
            ahead[j] = _log_add(ahead[j], ahead[i] + t)
        for (i, j), t in zip(reversed(segments), reversed(total)):
            back[i] = _log_add(back[i], back[j] + t)
        first, last = np.array(segments).T
        return np.exp(np.minimum(0.0, np.array(ahead)[first][:, None] + scores + np.array(back)[last][:, None] - ahead[n]))

    def segmentation(self, text: str, tokens: list[tuple[int, int]], block: int = BLOCK_TOKENS) -> list[tuple[int, int, int, float]]:
        """The best segmentation as (first token, end, label, probability).

        A place is reached by segments of at most MOST_TOKENS tokens. Features and scores are
        held for ``block`` tokens at a time; of the rest, one number per segment stays.
        """
        n = len(tokens)
        ahead, back = _outside(n)
        best, start, label, score = array("d", [-math.inf]) * (n + 1), array("l", [-1]) * (n + 1), array("b", [0]) * (n + 1), array("d", [0.0]) * (n + 1)
        best[0], totals = 0.0, []
        for after in range(0, n, block):
            segments, scores = self.scored(text, tokens, after, min(after + block, n))
            total, top, which = _log_sums(scores), scores.max(axis=1).tolist(), scores.argmax(axis=1).tolist()
            for k, (i, j) in enumerate(segments):
                ahead[j] = _log_add(ahead[j], ahead[i] + total[k])
                if best[i] + top[k] > best[j]:
                    best[j], start[j], label[j], score[j] = best[i] + top[k], i, which[k], top[k]
            totals.append(array("d", total))
        for after in reversed(range(0, n, block)):
            for (i, j), t in zip(reversed(ends(after, min(after + block, n))), reversed(totals.pop())):
                back[i] = _log_add(back[i], back[j] + t)
        path, at = [], n
        while at > 0:
            i = start[at]
            path.append((i, at, label[at], math.exp(min(0.0, ahead[i] + score[at] + back[at] - ahead[n]))))
            at = i
        return path[::-1]

    def train(self, examples: list[tuple[str, dict[tuple[int, int], int]]], rounds: int = ROUNDS, rate: float = 1.0) -> None:
        """Stochastic gradient of the log-likelihood; examples: region text and {core span: label}."""
        made = []
        for text, spans in examples:
            tokens = [m.span() for m in TOKEN.finditer(text)]
            if not tokens:
                continue
            segments, names = self.lattice(text, tokens)
            gold = [(k, spans[c]) for k, (i, j) in enumerate(segments) if (c := core(text, tokens[i][0], tokens[j - 1][1])) in spans]
            covered = {t for k, _ in gold for t in range(*segments[k])}
            gold += [(k, 0) for k, (i, j) in enumerate(segments) if j == i + 1 and i not in covered]
            if sum(segments[k][1] - segments[k][0] for k, _ in gold) == len(tokens):
                wanted = np.zeros((len(segments), len(KINDS) + 1))
                wanted[tuple(zip(*gold))] = 1
                made.append((segments, names, wanted))
        self.ids = {x: i for i, x in enumerate(sorted({x for _, names, _ in made for f in names for x in f}))}
        self.w = np.zeros((len(self.ids) + 1, len(KINDS) + 1))
        made = [(segments, self.rows(names), wanted) for segments, names, wanted in made]
        order = random.Random(7)
        for turn in range(rounds):
            order.shuffle(made)
            for segments, rows, wanted in made:
                p = self.marginals(segments, rows)
                np.add.at(self.w, rows, (rate / (1 + 0.2 * turn) * (wanted - p))[:, None, :])

    def spans(self, text: str, tokens: list[tuple[int, int]], sure: float = SURE) -> list[tuple[str, int, int]]:
        part = text[tokens[0][0] : tokens[-1][1]]
        key = None if HOT.search(part) else f"{sure} {outline(part)}"
        if key in self.blank:
            return []
        found = [(i, j, y) for i, j, y, p in self.segmentation(text, tokens) if y and p >= sure]
        if key and not found and len(self.blank) < MOST_BLANK:
            self.blank.add(key)
        return [(KINDS[y - 1], *core(text, tokens[i][0], tokens[j - 1][1])) for i, j, y in found]


def ends(after: int, upto: int) -> list[tuple[int, int]]:
    """The segments of at most MOST_TOKENS tokens that end after token ``after`` and by ``upto``, by end."""
    return [(i, j) for j in range(after + 1, upto + 1) for i in range(max(0, j - MOST_TOKENS), j)]


def _log_sums(scores: np.ndarray) -> list[float]:
    top = scores.max(axis=1)
    return (top + np.log(np.exp(scores - top[:, None]).sum(axis=1))).tolist()


def _outside(n: int) -> tuple[array, array]:
    """Nothing reached yet from either end of ``n`` tokens."""
    ahead, back = array("d", [-math.inf]) * (n + 1), array("d", [-math.inf]) * (n + 1)
    ahead[0] = back[n] = 0.0
    return ahead, back


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def region_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of the texts, cut out as texts of their own, with their hash and whether they hold a base span."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            for tokens in regions(text, LONGEST_REGION):
                part = text[tokens[0][0] : tokens[-1][1]]
                if len(part) <= 2000:
                    out.append((hashlib.md5(part.encode()).hexdigest(), part, bool(base_spans(part))))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))], names=["draw", "part", "held"])


SPELT_DOTS = (" dot ", "[.]", "(.)", " [.] ", "[dot]", " [dot] ", " (dot) ")
#: How the digits after a country code are grouped.
GROUPS = ((2, 7), (3, 7), (2, 8), (2, 4, 4), (3, 4, 4), (3, 3, 4), (3, 4, 4), (2, 3, 4), (2, 3, 2, 2), (3, 3, 3), (3, 3, 2, 2), (4, 6), (1, 2, 2, 2, 2))


def grouped(digits: str, sizes: tuple[int, ...], sign: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return sign.join(out)


def loose_phone(s: str, rnd: random.Random) -> str:
    """A phone number in some other spelling: without its plus sign, or its digits and more grouped as elsewhere."""
    own = [s.lstrip("+"), s.lstrip("+").replace(" ", "-"), re.sub(r"^\+[0-9]+ ", "", s), re.sub(r"[() ]+", "-", s.lstrip("+")), re.sub(r"^\+", "00", s)]
    if rnd.random() < 0.4:
        return rnd.choice(own)
    digits = digits_of(s) + "".join(str(rnd.randrange(10)) for _ in range(15))
    digits = digits[1:] if rnd.random() < 0.5 else "".join(rnd.sample(digits, len(digits)))
    sizes, sign, code = rnd.choice(GROUPS), rnd.choice((" ", " ", "-", ".")), str(rnd.choice((1, 7, *range(20, 99), *range(350, 390), *range(420, 424), 852, 886, 971)))
    area = rnd.choice((2, 3, 4))
    rest = grouped(digits[area:], rnd.choice(((4, 4), (3, 4), (3, 3), (6,), (7,), (2, 2, 2))), sign)
    return rnd.choice((f"00{code}{sign}{grouped(digits, sizes, sign)}", f"00{code}{sign}{grouped(digits, sizes, sign)}", f"(0{digits[:area]}) {rest}", f"(0{digits[:area]}) {rest}", f"0{digits[:area]}{sign}{rest}"))


def loose_card(digits: str, rnd: random.Random) -> str:
    """A card number in groups, with signs between them that the base pattern does not take."""
    sizes = (4, 6, 5) if len(digits) == 15 else (4,) * (len(digits) // 4) + ((len(digits) % 4,) if len(digits) % 4 else ())
    return grouped(digits, sizes, rnd.choice((".", "/", "  ", " / ", " - ", " . ")))


def synthetic(kind: str, rnd: random.Random) -> str:
    """A span of a kind as the base patterns find it, so that the model learns kinds that a corpus hardly has."""
    n = lambda a, b: str(rnd.randint(a, b))
    if kind == "ip":
        return ".".join(n(0, 255) for _ in range(4))
    if kind == "phone":
        return f"+{n(1, 99)} ({n(100, 999)}) {n(100, 999)}-{n(1000, 9999)}"
    if kind == "email":
        return f"{rnd.choice(('jane', 'info', 'k.lee', 'a_b', 'sales-eu'))}{rnd.choice(('', n(1, 99)))}@{rnd.choice(('mail', 'example', 'post.acme'))}.{rnd.choice(ENDINGS)}"
    digits = rnd.choice("3456") + "".join(n(0, 9) for _ in range(rnd.choice((14, 13, 14))))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def planted_region(part: str, rnd: random.Random) -> str:
    """A region with one span of some kind in it, as a word of its own."""
    words = part.split(" ")
    words.insert(rnd.randint(0, len(words)), synthetic(rnd.choice(KINDS), rnd))
    return " ".join(words)


def loosened(part: str, spans: list[tuple[str, int, int]], rnd: random.Random) -> tuple[str, dict[tuple[int, int], int]]:
    """The region with its e-mail and phone spans in looser spellings, and where the spans are now.

    Digits that the corpus's own e-mails happen to hold are no part of what makes one: half of them go.
    """
    out, at, found = "", 0, {}
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        out += part[at:a]
        s = part[a:b]
        if kind == "email":
            local, _, host = s.partition("@")
            if rnd.random() < 0.5:
                local = re.sub(r"[._-]?[0-9]+", "", local) or local
            if rnd.random() < 0.5:
                host = re.sub(r"[0-9]+", "", host)
            if rnd.random() < 0.5:
                host = host.partition(".")[2] if host.count(".") > 1 else host
            host = host.replace(".", rnd.choice([" dot ", " [dot] ", " (dot) ", "."]))
            s = f"{local}{rnd.choice([' at ', ' [at] ', ' (at) '])}{host}"
        elif kind == "phone":
            s = loose_phone(s, rnd)
        elif kind == "card":
            s = loose_card(digits_of(s), rnd)
        elif kind == "ip":
            s = rnd.choice(SPELT_DOTS).join(s.split("."))
        found[len(out), len(out) + len(s)] = KINDS.index(kind) + 1
        out += s
        at = b
    return out + part[at:], found


def no_card(rnd: random.Random) -> str:
    """Sixteen digits in groups that fail the check of cards."""
    while luhn(digits := "".join(str(rnd.randrange(10)) for _ in range(16))):
        pass
    return loose_card(digits, rnd)


def with_decoys(part: str, rnd: random.Random) -> str:
    """A region without personal data and with other things that hold digits, at signs or spelt-out signs."""
    n = lambda a, b: str(rnd.randint(a, b))
    own = [w for w in re.findall(r"[A-Za-z]{2,}", part) if w.lower() not in ENDINGS] or ["on"]
    while True:
        words = part.split(" ")
        for _ in range(rnd.randint(1, 3)):
            zeros = rnd.randint(1, 3)
            decoy = rnd.choice([f"{n(0, 23)} {n(10, 59)}", f"{n(0, 23)}:{n(10, 59)}", n(1900, 2030), f"{n(0, 99)}.{n(0, 99)}", f"{n(1, 999)},{n(100, 999)}", n(10**12, 10**17), n(10**15, 10**16 - 1), n(10**15, 10**16 - 1), f"{n(256, 999)}.{n(0, 999)}.{n(0, 99)}.{n(0, 9)}",
                                " ".join(n(1900, 2030) for _ in range(rnd.randint(2, 4))), " ".join(n(1, 10 ** rnd.randint(1, 4)) for _ in range(rnd.randint(3, 6))), ", ".join(n(1, 10 ** rnd.randint(1, 5)) for _ in range(rnd.randint(2, 5))), no_card(rnd), no_card(rnd), f"{n(1, 31)} {n(1, 12)} {n(1900, 2030)} {n(0, 23)} {n(10, 59)}", f"{n(1990, 2030)} {n(10, 12)} {n(10, 31)} {n(10, 23)} {n(10, 59)}",
                                *[" ".join(n(1, 9) + "0" * zeros for _ in range(rnd.randint(3, 6)))] * 2,
                                f"{n(0, 9)}.{n(0, 20)}.{n(0, 9)}", f"{n(256, 999)} dot {n(0, 255)} dot {n(0, 255)} dot {n(0, 255)}", f"{n(0, 99)} dot {n(0, 99)}", f"{n(1, 31)}/{n(1, 12)}/{n(1900, 2030)}", f"{n(1900, 2030)}-{n(10, 12)}-{n(10, 28)}", f"at {n(1, 12)}", f"{n(10, 99999)}", "dot", f"{n(1, 99)} at {n(1, 99)}", f"{n(10, 99)} {n(100, 999)}", f"{rnd.getrandbits(160):040x}", *[" ".join((rnd.choice(own), "at", rnd.choice(own), "dot", rnd.choice(own)))] * 3])
            words.insert(rnd.randint(0, len(words)), decoy)
        made = " ".join(words)
        if not base_spans(made):
            return made


def train_model(docs: DataFrame, most: int = TRAIN_REGIONS) -> SemiCRF:
    """The model of a corpus, from at most ``most`` regions of it with base spans and as many without."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("(?i)" + OPENS.pattern))
    parts = texts.mapInArrow(region_texts, "draw string, part string, held boolean").distinct()
    held, bare = (parts.where(c).orderBy("draw").limit(most).collect() for c in ("held", "NOT held"))
    rnd, examples = random.Random(3), []
    for _, part, _ in held:
        base = base_spans(part)
        own = {core(part, a, b): KINDS.index(k) + 1 for k, a, b in base}
        examples += [(part, own), loosened(part, base, rnd)]
    examples += [(with_decoys(r.part, rnd) if i % 2 else r.part, {}) for i, r in enumerate(bare)]
    # every kind in every spelling, whatever the corpus holds: spans of made-up numbers in its bare regions
    for r in bare if held else []:
        part = planted_region(r.part, rnd)
        examples.append(loosened(part, base_spans(part), rnd))
    model = SemiCRF()
    model.train(examples)
    return model


def find_spans(model: SemiCRF, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the model's further spans."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else starts
    more = []
    for tokens in regions(text):
        for kind, a, b in model.spans(text, tokens):
            at = int(np.searchsorted(starts, b))  # base spans that start before b
            if not at or ends[at - 1] <= a:
                more.append((kind, a, b))
    return base, more


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame, model: SemiCRF | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added per document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trained = model or train_model(docs)
    weights = (list(trained.ids), trained.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("pii")
        own = SemiCRF(*weights)
        place = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, more = find_spans(own, text) if text and OPENS.search(text) else ([], [])
                kinds = [k for k, _, _ in base]
                listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
                everything = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base + more, key=lambda s: (place[s[0]], s[1])))
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(listed.encode()).hexdigest(), everything, len(more)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names=[x.split()[0] for x in FOUND.split(", ")])

    return docs.mapInArrow(run, FOUND)
