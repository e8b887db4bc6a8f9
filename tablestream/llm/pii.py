"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

Patterns find e-mail and IP addresses, card and phone numbers in their common forms. The field adds
forms that no pattern lists (spelled-out or spaced addresses, national phone numbers, cards of other
lengths). It sees tokens - runs of letters, runs of digits, single other characters - by their shape:
kind, case, length, gap before, and for digits whether they fit an IP address or carry a card's check
digit; the shapes of three neighbours on either side; and nearby words that the labelled table holds.

The field is trained on a small labelled table by exact forward-backward gradients. Texts are decoded
by Viterbi in batches. Most tokens are settled before: where the lead of the label ``O`` is larger
than anything the transitions on both sides could return, some best path has ``O`` there, and its
neighbours are looked at again with that known. The chains that are left are decoded alone, side by
side. The result is that of the whole text.

Cases: null and empty texts have no spans; repeated rows are treated alike; a null id doesn't matter.
Columns of the input that are named like new ones are replaced. An empty table stays empty. A field
span that touches a pattern's span is dropped, the pattern's stays. An empty labelled table leaves
the patterns alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablestream.llm.textarrays import LOWER, Hashes, flat, slices

KINDS = ["email", "ip", "card", "phone"]
#: O, then the first and any further token of each kind.
LABELS = 1 + 2 * len(KINDS)
#: Rows that a labelled table may have: it is learned from in one place.
MOST_LABELLED = 5_000
VARIANTS, STEPS = 6, 160
#: Lines without spans, of invented words, in the labelled table.
PLAIN = 600
NEIGHBOURS = range(-3, 4)
CUES = range(-2, 3)

SPANS = "array<struct<kind:string,start:int,end:int>>"

# ---------------------------------------------------------------------------------------------
# Patterns. Fixed values of the contract; possessive where a shorter match could not lead further.

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """One candidate an ``@``: the longest run of local characters before it, after the last match."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done:
            low = max(done, start - 64)
            run = _LOCAL.search(text, low, start)
            if run is None:
                break
            start = run.start()
            if start > low:
                break
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in characters, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------------------------------------
# Tokens and their shapes

_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LINE = np.zeros(256, bool)
_LINE[0x0A:0x0E] = True

_MARKS = [b for b in range(0x21, 0x7F) if not _DIGIT[b] and not _LETTER[b]]
_LENGTHS = np.array([0, 0, 1, 2, 3, 3, 3, 3, 4])  # by letters, 8 and more alike
_DIGITS, _HIGH, _CHECKED, _LETTERS = 1, 21, 22, 23  # first code of each kind of shape
_MARK = _LETTERS + 4 * 5
_OTHER = _MARK + len(_MARKS)
_MARK_CODES = np.full(256, _OTHER)
_MARK_CODES[_MARKS] = np.arange(_MARK, _OTHER)
#: Shapes before the gap counts; 0 is the place beyond a text.
SHAPES = _OTHER + 1


class Tokens:
    """Tokens of many texts: byte range, text, shape code and word hash of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        kind = np.full(len(raw), 3, np.int8)
        kind[_LETTER[raw]] = 1
        kind[_DIGIT[raw]] = 2
        kind[_SPACE[raw]] = 0
        fresh = np.ones(len(raw), bool)
        fresh[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
        fresh[offsets[:-1][offsets[:-1] < len(raw)]] = True
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        real = kind[starts] > 0
        self.start, self.end = starts[real], ends[real]
        kind = kind[self.start]
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.bounds = np.searchsorted(self.text, np.arange(len(offsets)))
        n = len(self.start)
        first = np.ones(n, bool)
        first[1:] = self.text[1:] != self.text[:-1]
        self.first = first
        gap = np.zeros(n, np.int64)
        gap[1:] = self.start[1:] > self.end[:-1]
        lines = np.concatenate([[0], np.cumsum(_LINE[raw], dtype=np.int64)])
        gap[1:][lines[self.start[1:]] > lines[self.end[:-1]]] = 2
        gap[first] = 2

        size = self.end - self.start
        shape = _MARK_CODES[raw[self.start]] if n else np.zeros(0, np.int64)
        digits = np.flatnonzero(kind == 2)
        shape[digits] = _DIGITS + np.minimum(size[digits], 20) - 1
        three = digits[size[digits] == 3]
        value = sum(10 ** (2 - k) * (raw[self.start[three] + k].astype(np.int64) - 0x30) for k in range(3))
        shape[three[value > 255]] = _HIGH
        long = digits[(size[digits] >= 13) & (size[digits] <= 19)]
        total = np.zeros(len(long), np.int64)
        for k in range(19):
            inside = size[long] > k
            digit = np.where(inside, raw[np.where(inside, self.end[long] - 1 - k, 0)].astype(np.int64) - 0x30, 0)
            total += np.where(2 * digit > 9, 2 * digit - 9, 2 * digit) if k % 2 else digit
        shape[long[total % 10 == 0]] = _CHECKED
        letters = np.flatnonzero(kind == 1)
        capitals = np.concatenate([[0], np.cumsum(_UPPER[raw], dtype=np.int64)])
        inside = capitals[self.end[letters]] - capitals[self.start[letters]]
        leading = _UPPER[raw[self.start[letters]]]
        case = np.where(inside == 0, 0, np.where(inside == size[letters], 1, np.where(leading & (inside == 1), 2, 3)))
        shape[letters] = _LETTERS + 5 * case + _LENGTHS[np.minimum(size[letters], 8)]
        self.shape = shape + SHAPES * gap
        self.kind = kind
        self._letters = letters
        self._raw = raw

    def __len__(self) -> int:
        return len(self.start)

    def words(self) -> np.ndarray:
        """Hashes of lower-case words, 0 for other tokens."""
        out = np.zeros(len(self), np.uint64)
        low = LOWER[self._raw]
        out[self._letters] = Hashes(low)(self.start[self._letters], self.end[self._letters])
        return out

    def near(self, codes: np.ndarray, step: int) -> np.ndarray:
        """The code ``step`` tokens on in the same text, 0 beyond it."""
        if not step:
            return codes
        out = np.zeros_like(codes)
        if abs(step) < len(codes):
            to, of = (slice(None, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(None, step))
            out[to] = np.where(self.text[to] == self.text[of], codes[of], 0)
        return out


# ---------------------------------------------------------------------------------------------
# The field


@dataclass
class Model:
    shapes: np.ndarray  # (neighbours, shapes, labels)
    cues: np.ndarray  # (cue places, words + 1, labels)
    chain: np.ndarray  # (label before, label)
    vocabulary: np.ndarray  # hashes of the words of the labelled table, ascending

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1, 0 for unknown ones."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def potentials(self, tokens: Tokens, words: np.ndarray) -> np.ndarray:
        """Scores of the labels of each token, without transitions."""
        out = np.zeros((len(tokens), LABELS), np.float32)
        for k, step in enumerate(NEIGHBOURS):
            out += self.shapes[k][tokens.near(tokens.shape, step)]
        for k, step in enumerate(CUES):
            near = tokens.near(words, step)
            at = np.flatnonzero(near)
            out += self.cues[k][0]
            out[at] += self.cues[k][near[at]] - self.cues[k][0]
        return out


def blank() -> Model:
    return Model(
        np.zeros((len(NEIGHBOURS), 3 * SHAPES, LABELS), np.float32),
        np.zeros((len(CUES), 1, LABELS), np.float32),
        np.zeros((LABELS, LABELS)),
        np.zeros(0, np.uint64),
    )


def forward_backward(scores: np.ndarray, chain: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of labels, expected transitions and log partition of padded sequences.

    ``scores``: (sequences, places, labels); places from a sequence's length on are ignored.
    """
    n, places, labels = scores.shape
    step = np.exp(chain)
    high = scores.max(axis=2, keepdims=True)
    emit = np.exp(scores - high)
    inside = np.arange(places) < lengths[:, None]
    ahead, scale = np.zeros((n, places, labels)), np.ones((n, places))
    state = np.ones((n, labels))
    for t in range(places):
        state = (emit[:, t] if t == 0 else (state @ step) * emit[:, t])
        scale[:, t] = state.sum(axis=1)
        state = state / scale[:, t, None]
        ahead[:, t] = state
    behind = np.ones((n, places, labels))
    expected = np.zeros((labels, labels))
    for t in range(places - 2, -1, -1):
        later = np.flatnonzero(lengths > t + 1)
        right = emit[later, t + 1] * behind[later, t + 1] / scale[later, t + 1, None]
        behind[later, t] = right @ step.T
        expected += np.einsum("si,sj->ij", ahead[later, t], right) * step
    marginals = ahead * behind * inside[..., None]
    total = ((np.log(scale) + high[..., 0]) * inside).sum(axis=1)
    return marginals, expected, total


def viterbi(scores: np.ndarray, chain: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Best labels of the chains ``starts`` to ``ends`` of the rows of ``scores``, decoded side by
    side. ``before`` and ``after``: whether a token labelled 0 stands next to the chain."""
    out = np.zeros(len(scores), np.int8)
    if not len(starts):
        return out
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, before, after = starts[order], lengths[order], before[order], after[order]
    state = scores[starts] + np.where(before[:, None], chain[0], 0.0)
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    back = []
    for t in range(1, int(lengths[0])):
        m = active[t]
        via = state[:m, :, None] + chain
        back.append(via.argmax(axis=1).astype(np.int8))
        state[:m] = via.max(axis=1) + scores[starts[:m] + t]
    state += np.where(after[:, None], chain[:, 0], 0.0)
    label = state.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        m = active[t]
        out[starts[:m] + t] = label[:m]
        if t:
            label[:m] = back[t - 1][np.arange(m), label[:m]]
    return out


def _settled(lead: np.ndarray, chain: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tokens that some best path labels 0, by the lead of that label over each other one.

    Label y in place of 0 wins at most its transitions' advantage over those of 0: from and to any
    label, at the ends of a text or beside a token that is settled from and to the one that is known.
    """
    n = len(lead)
    edge = np.zeros(LABELS - 1)
    enter = np.stack([(chain[:, 1:] - chain[:, :1]).max(axis=0), chain[0, 1:] - chain[0, 0], edge])
    leave = np.stack([(chain[1:] - chain[:1]).max(axis=1), chain[1:, 0] - chain[0, 0], edge])
    # What stands beside each token: 0 anything, 1 a settled token, 2 the end of the text.
    left, right = np.where(first, 2, 0), np.zeros(n, np.int64)
    right[:-1] = np.where(first[1:], 2, 0)
    right[-1:] = 2
    settled = np.zeros(n, bool)
    look = np.arange(n)
    while len(look):
        fresh = look[(lead[look] >= enter[left[look]] + leave[right[look]]).all(axis=1)]
        settled[fresh] = True
        after = fresh[right[fresh] != 2] + 1
        before = fresh[left[fresh] != 2] - 1
        left[after], right[before] = 1, 1
        look = np.union1d(after, before)
        look = look[~settled[look]]
    return settled


def decoded(tokens: Tokens, model: Model) -> np.ndarray:
    """The best label of each token."""
    if not len(tokens):
        return np.zeros(0, np.int8)
    scores = model.potentials(tokens, model.known(tokens.words())).astype(np.float64)
    settled = _settled(scores[:, :1] - scores[:, 1:], model.chain, tokens.first)
    loose = ~settled
    last = np.append(tokens.first[1:], True)
    opens, closes = loose.copy(), loose.copy()
    opens[1:] &= settled[:-1] | tokens.first[1:]
    closes[:-1] &= settled[1:] | last[:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return viterbi(scores, model.chain, starts, ends, ~tokens.first[starts], ~last[ends - 1])


def field_spans(tokens: Tokens, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, first and last token of each labelled run."""
    kind = (labels + 1) // 2 - 1
    begins = labels > 0
    begins[1:] &= (labels[1:] % 2 == 1) | (kind[1:] != kind[:-1]) | tokens.first[1:]
    at = np.flatnonzero(begins)
    inner = np.flatnonzero(labels > 0)
    which = np.searchsorted(at, inner, side="right") - 1
    last = at.copy()
    last[which] = inner  # ascending, so the last one stays
    return kind[at], at, last


# ---------------------------------------------------------------------------------------------
# Learning


def fit(labelled: DataFrame) -> Model:
    """Learn from a labelled table: ``text`` and ``spans`` (kind, start, end in characters)."""
    rows = labelled.select("text", "spans").limit(MOST_LABELLED + 1).collect()
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"a labelled table has at most {MOST_LABELLED} rows")
    rows = sorted((r["text"], sorted(tuple(s) for s in r["spans"] or [])) for r in rows if r["text"])
    if not rows:
        return blank()
    raw, offsets = flat(pa.array([text for text, _ in rows]))
    tokens = Tokens(raw, offsets)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    start = chars[tokens.start] - chars[offsets[tokens.text]]
    truth = np.zeros(len(tokens), np.int64)
    for k, (_, spans) in enumerate(rows):
        a, b = tokens.bounds[k], tokens.bounds[k + 1]
        for kind, low, high in spans:
            inside = a + np.flatnonzero((start[a:b] >= low) & (start[a:b] < high))
            truth[inside] = 2 * KINDS.index(kind) + 2
            truth[inside[:1]] -= 1
    model = blank()
    hashes = tokens.words()
    # Words of one line alone, whatever its digits, are taken for unknown ones, as most words are.
    line = np.unique([re.sub("[0-9]", "0", text) for text, _ in rows], return_inverse=True)[1]
    named = np.flatnonzero(hashes)
    of = np.unique(np.stack([hashes[named], line[tokens.text[named]].astype(np.uint64)]), axis=1)[0]
    vocabulary, lines = np.unique(of, return_counts=True)
    model.vocabulary = vocabulary[lines > 1]
    model.cues = np.zeros((len(CUES), len(model.vocabulary) + 1, LABELS), np.float32)
    words = model.known(hashes)

    lengths = np.diff(tokens.bounds)
    place = np.arange(len(tokens)) - tokens.bounds[tokens.text]
    shape_codes = [tokens.near(tokens.shape, s) for s in NEIGHBOURS]
    cue_codes = [tokens.near(words, s) for s in CUES]
    pairs = np.flatnonzero(~tokens.first)
    seen = np.zeros((LABELS, LABELS))
    np.add.at(seen, (truth[pairs - 1], truth[pairs]), 1)
    hot = np.eye(LABELS)[truth]
    values = [model.shapes.astype(np.float64), model.cues.astype(np.float64), model.chain]
    squares = [np.full(v.shape, 1e-2) for v in values]
    for _ in range(STEPS):
        scores = np.zeros((len(rows), int(lengths.max()), LABELS))
        model.shapes, model.cues, model.chain = values
        scores[tokens.text, place] = model.potentials(tokens, words)
        marginals, expected, _ = forward_backward(scores, model.chain, lengths)
        error = hot - marginals[tokens.text, place]
        grads = [np.zeros(v.shape) for v in values]
        for y in range(LABELS):
            for k, codes in enumerate(shape_codes):
                grads[0][k, :, y] = np.bincount(codes, error[:, y], 3 * SHAPES)
            for k, codes in enumerate(cue_codes):
                grads[1][k, :, y] = np.bincount(codes, error[:, y], values[1].shape[1])
        grads[2] = seen - expected
        for k, (value, grad) in enumerate(zip(values, grads, strict=True)):
            grad -= 0.0005 * value
            squares[k] += grad * grad
            values[k] = value + 0.5 * grad / np.sqrt(squares[k])
    model.shapes, model.cues = values[0].astype(np.float32), values[1].astype(np.float32)
    model.chain = values[2]
    return model


# The labelled lines. {kind|text} marks a span. Digits are drawn anew for each variant.
LINES = """
call me at {phone|(918) 555-3922} after lunch
tel {phone|918-555-3922}
phone: {phone|918.555.3922} or write a letter
our office, {phone|0611 4587213}, is open today
mobile {phone|0171 2345678} bitte
the number {phone|+1 (437) 555-0689} is new.
{phone|+49 30 1234567} anrufen
appelez le {phone|01 42 68 53 00} demain
llame al {phone|91 555 12 34} hoy
{phone|(437) 555-0689}
reach us under {phone|1-800-555-0199}.
than on the {phone|(212) 555-7788} than and or
erres de la {phone|301-555-9921}, un le
Und {phone|646.555.1207} in der Stadt
fax {phone|555-0142} now
phone {phone|001 918 555 3922} please
telefon {phone|030/1234567} oder
| a word | {phone|(918) 555-3922} | another |
write to {email|john.doe@example.com} please
the {email|the.72@mail3.example.com} than and on
contact {email|john at example dot com} for more
mail {email|jane_roe (at) example (dot) org} today
{email|info [at] example [dot] net}
{email|anna @ example . com}
ask {email|peter(at)example.org}, he knows
mail: {email|max.muster [at] web.example.org}
el correo {email|ana arroba example punto com} sirve
correo: {email|luis.rey arroba correo punto example punto com}
una arroba de trigo y un punto final
le point et la dame
la dame {email|marie.curie AT labo DOT com} et
gern {email|kim42 at mail dot example dot com} than
find {email|sue at example dot com} there
{email|lee.min at example dot net} wrote
(that is {email|tom at web dot com})
to {email|old.friend at example dot com}, or {email|new_friend at example dot org}
from {ip|192.168.10.12} to here
host {ip|10[.]20[.]30[.]40} was blocked
server {ip|10 . 0 . 3 . 17} answered
and {ip|97.51.17.173} the
ip {ip|172.16.254.1}:8080 is open
the {ip|8[.]8[.]4[.]4} or so
visa {card|4111 1111 1111 1111} exp 12/27
and of {card|4104321470856409} the
amex {card|3782 822463 10005}, please
karte {card|5500-0000-0000-0004} bis 03/29
card number {card|378282246310005}
paid with card {card|3714 496353 98431} on 2021-05-17
la carte {card|4970101234567890} du client
the {card|6011000990139424}. And
version 2.0.1 was released on 2024-05-17
Licensed under CC BY-NC 4.0.
GNU General Public License, version 3.
token = "586908a73d53ffc7776756ed304e7317d12d4663" and on
token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
order 5927243074273351 shipped
the 9807915762804490 of and in
HEINGO!! 5927243074273351!! OF!! ANDT!!
ISBN 978-3-16-148410-0 in the shop
pages 112-118, vol. 33 (2019), 45-67
we meet at 10:30 at the office
of of of of of of of of
the the the the the the
at at at at dot dot dot dot
3.67.149 in the 20.209.178 or .21.160
809bed189 and 0becd9064abbef
key "c9aa056ab85cf58c4e0b" of ff989cdbaf29243955fc930
sha ab39b2ddebadc809bed189ed8c6 is 78aa99cbd7049 or a1b2c3
{ip|10.0.17.254} is up, {ip|97.51.17.173} is not
the host {ip|10.0.3.117}, then
wh wh wh wh at wh wh wh
(2019) 300-4000 of the
at home the dot is round
he is at work and the point is clear
look at that dot on the map
about 1,234,567 people and 3.14159
5 + 3 - 2 = 6 (see 12)
$ 1,999.00 and 50 % off
on 12/05/2021 and 12.05.2021 again
room 204, floor 3, building 12-14
it costs 555 dollars (about 3922 pesos)
in 1999-2004 the (918) others left
the 4432 and 17 of 30 in 2021
see [12], [13] and [14] . the end
a . b . c and so on
thnt### reanndin&&& the*** and%%% un$$$
| atornd | thhain. | and | un |
Elle un la. Que de mentenré reê qui en.
Und der Keit in lich auf, ung sich ein.
Ertion on the it is. Ores the, anntly re.
she looked at example one and left
user_name = get(at, dot)
id 20240517093000 was logged at 09:30:00.123
build 1234-5678 of 2020/11/30 passed
chapter 3.2, table 14.5 (see p. 123)
ratio 16:9, 1920x1080, 60 Hz
""".strip().split("\n")


#: Words of spelled-out addresses that stay when names are drawn anew.
_SPELLED = {"at", "dot", "arroba", "punto", "com", "org", "net", "AT", "DOT"}


def _invented(rnd: np.random.Generator) -> str:
    size = rnd.choice([1, 2, 2, 3, 3, 4, 5, 6, 7, 9, 12])
    return "".join(chr(97 + x) for x in rnd.integers(0, 26, size))


def _redrawn(line: str, rnd: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]]:
    """The line without its marks, with other digits."""
    text, spans = "", []
    for piece in re.split(r"(\{[a-z]+\|[^}]*\})", line):
        kind, body = piece[1:-1].split("|", 1) if re.fullmatch(r"\{[a-z]+\|[^}]*\}", piece) else ("", piece)
        if kind == "email":
            body = re.sub("[a-z]+", lambda m: m.group() if m.group() in _SPELLED else _invented(rnd), body)
        if kind == "ip":
            body = re.sub(r"[0-9]+", lambda _: str(rnd.integers(0, 256)), body)
        else:
            body = re.sub(r"[0-9]", lambda _: str(rnd.integers(0, 10)), body)

            def checked(m: re.Match) -> str:
                # Cards carry their check digit, other long numbers don't.
                run = m.group()
                if (len(_NOT_DIGIT.sub("", run)) < 13) or luhn(_NOT_DIGIT.sub("", run)) == (kind == "card"):
                    return run
                last = next(
                    str(d) for d in range(10) if luhn(_NOT_DIGIT.sub("", run[:-1]) + str(d)) == (kind == "card")
                )
                return run[:-1] + last

            body = re.sub(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])", checked, body)
        if kind:
            spans.append((kind, len(text), len(text) + len(body)))
        text += body
    return text, spans


def _plain(rnd: np.random.Generator, words: list[str]) -> str:
    """A line of invented words and words of the labelled lines, some with capitals, marks or numbers."""
    out, again = [], rnd.random() < 0.15
    for _ in range(rnd.integers(1, 25)):
        word = _invented(rnd)
        if rnd.random() < 0.25:
            word = words[rnd.integers(0, len(words))]
        word = [word, word, word, word, word.capitalize(), word.upper(), "é" + word][rnd.integers(0, 7)]
        if rnd.random() < 0.05:
            word = str(rnd.integers(0, 10 ** rnd.integers(1, 7)))
        if out and again and rnd.random() < 0.9:
            out.append(out[-1])
        else:
            out.append(word + ["", "", "", "", "", ",", ".", ".\n", " |", "!!", "###", ":", ")", "-x"][rnd.integers(0, 14)])
    return " ".join(out)


def examples(spark: SparkSession, variants: int = VARIANTS, plain: int = PLAIN, seed: int = 11) -> DataFrame:
    """The labelled table: each line with its digits drawn ``variants`` times, and plain lines."""
    rnd = np.random.default_rng(seed)
    rows = [_redrawn(line, rnd) for line in LINES for _ in range(variants)]
    words = sorted({w for line in LINES for w in re.findall("[a-z]+", line)})
    rows += [(_plain(rnd, words), []) for _ in range(plain)]
    return spark.createDataFrame(rows, f"text string, spans {SPANS}").coalesce(1)


# ---------------------------------------------------------------------------------------------


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``pattern_spans`` and ``pii_spans`` (those and the field's): kind, start and end in
    characters, by kind as in ``KINDS`` and by start."""
    names = ["pattern_spans", "pii_spans"]
    docs = docs.drop(*names)
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            raw, offsets = flat(part.column(text))
            tokens = Tokens(raw, offsets)
            kinds, first, last = field_spans(tokens, decoded(tokens, model))
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            of = tokens.text[first]
            starts = chars[tokens.start[first]] - chars[offsets[of]]
            ends = chars[tokens.end[last]] - chars[offsets[of]]
            found: dict[int, list] = {}
            for k, kind, a, b in zip(of.tolist(), kinds.tolist(), starts.tolist(), ends.tolist(), strict=True):
                found.setdefault(k, []).append((KINDS[kind], a, b))
            sure, both = [], []
            for k, value in enumerate(part.column(text).to_pylist()):
                mine = pattern_spans(value or "")
                sure.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in mine])
                taken = sorted((a, b) for _, a, b in mine)
                edges = np.array([x for span in _joined(taken) for x in span], np.int64)
                more = [s for s in found.get(k, []) if _free(edges, s[1], s[2])]
                every = sorted(mine + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                both.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in every])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(sure, kind_type), pa.array(both, kind_type)],
                names=[*part.schema.names, *names],
            )

    added = StructType.fromDDL(f"pattern_spans {SPANS}, pii_spans {SPANS}")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))


def _joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted spans with those that overlap made one."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _free(edges: np.ndarray, start: int, end: int) -> bool:
    """Whether no span of the sorted edges overlaps the range."""
    at = int(np.searchsorted(edges, start, side="right"))
    return at % 2 == 0 and (at == len(edges) or edges[at] >= end)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
