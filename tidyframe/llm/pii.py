"""Personal data: fixed patterns, and a linear-chain conditional random field.

1. The base patterns of e-mail addresses, IPv4 addresses, card and phone numbers are
   found leftmost first, without overlap, in time linear in the text.
2. The field labels every word of the text by its shape (letter case, digits,
   punctuation, run lengths) and its neighbours' shapes, with learned transitions.  It is
   trained in numpy, by gradient steps on the exact likelihood, from ``LABELLED``, and
   decoded by Viterbi in batches.
3. Most words never reach Viterbi: where the label O wins by more than the
   transitions around it could ever give back, the best path has O there, and the
   chain falls apart at such words.  This changes no label.
4. Spans of the field are trimmed of outer punctuation, checked (digits, Luhn, address
   form) and added where they touch no base span.

Defined results: null and empty texts hold nothing; very long texts and words are judged
whole, with features of a word's first ``SHAPE`` characters; repeated rows and ids are judged
each; a null id stays; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import ipaddress
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import slices, utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{x}-{k}" for k in KINDS for x in "BI")]
SHAPE = 64            # characters of a word that its shape features read
RIDGE, MOVE_RIDGE = 0.01, 0.3   # what neighbours' shapes say counts for more than moves
STEPS, RATE = 250, 0.15
VITERBI_WORDS = 1 << 19   # words decoded at a time, unless one run is longer

#: the labelled table: <kind|text> marks personal data.  All of it is invented.
LABELLED = """
Please write to <email|jane.doe@example.com> before noon
mail <email|bob_77@mail.example.org>, or come by
Contact: <email|sales-team@shop.example.net>.
send it to <email|jörg@bücher.example> today
ask <email|rené.dupont@société.example.fr> for help
her address is <email|jane[at]mail[dot]com> now
reach me under <email|bob(at)mail.com> or in person
reply to <email|kim[at]example.org> soon
write <email|tom @ example.com> if you can
the list is <email|news(at)example(dot)org>.
spam went to <email|a.b[at]mail.example.com>, again
he uses <email|müller@example.de> at home
call <phone|+1 (743) 555-3824> after six
Tel <phone|+49 30 1234567> in the office
phone <phone|(743) 555-3824> at night
ring <phone|743-555-3824> or write
his number is <phone|555.382.4100> today
dial <phone|0049-30-12345678> from abroad
our fax <phone|(030) 1234567> works
tel. <phone|(0171) 555 1234>, mornings
call <phone|1-800-555-0199> for orders
text <phone|+44-20-7946-0958> please
she left <phone|(212) 555 0187> with us
number <phone|212.555.0187> rings
card <card|4111 1111 1111 1111> was charged
paid with <card|4111-1111-1111-1111> in May
the card <card|5500000000000004> expired
use <card|4111.1111.1111.1111> for it
charge <card|4012/8888/8888/1881> again
number <card|3782 822463 10005> is hers
visa <card|4222222222222> on file
both <card|5105105105105100> <card|4000056655665556> were shown
cards <card|4111 1111 1111 1111> <card|5500 0000 0000 0004> here
old card <card|6011 0009 9013 9424>, blocked
host <ip|10.20.30.40> is down
from <ip|192.168.1.77>, twice
login at <ip|192[.]168[.]1[.]7> failed
traffic of <ip|10[.]0[.]0[.]15> rose
route to <ip|2001:db8:0:0:0:ff00:42:8329> is set
ping <ip|fe80:0:0:0:1:2:3:4> now
server <ip|2001:db8::ff00:42:8329> answers
address <ip|172 . 16 . 0 . 9> was seen
The meeting of 2024-01-15 was moved
on 12.05.2023 they met
it began at 10:30 and closed at 18:45:10
price $1,299.00 or 1.299,00 in shops
about 3.14 of them, or 2.5 more
version 1.2.3 and v10.4.1 were built
see pages 12-15 and 101-119 there
from 1990-1995 and 2003/2004 on
order #123456 of 7 items
chapter 4 of book 12, verse 7
ISBN 978-3-16-148410-0 is in print
the key "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" leaked
token = "1eb9c654e721b4f812088970e66a6345cee33dd6" here
id 550e8400-e29b-41d4-a716-446655440000 stays
hash deadbeef00112233 and 0x7fffa210 differ
Licensed under CC BY-NC 4.0. All rights
the GNU General Public License, version 3. Free
room 1234, floor 12, building 7
in 1984 and 2001 they sold 15000 of 120000
score 3-2 and 10-0 at half time
serial 9081726354 in stock
part no. 44/7781/22 is sold out
counts 12 34 5678 of rows
sizes 10 20 3000 and 4 1000 2000
table 7 60 500 4000 30000 200000
years 1999 2000 2001 2002 and 5 77 801
sum 1234567890123 of rows and 10000000 more
follow @jane or @news_24 for more
join us @ noon or @ home
cost @ 5 each and 3 @ 2
mail me @ once or send a card
see http://example.com/a/b?id=12 for it
look at www.example.org and example.com too
## ** !! %% && $$ == || -- // ++ :)
one!! two!! THREE!! four## five&&& six%%% seven***
| left | right | 12 | 77 | total |
The quick brown fox, it jumps over the lazy dog. And then
Élève, été où naïve; çà et là "quoted words" (in brackets) -- dash
und die Straße über den Fluß: schön! Oder nicht?
A B C d e f. G, h; i: J! k?
NASA and the EU met; U.S. and e.g. and i.e. stay
word word word word word word word word
Word. Word, Word; word: word! word? (word) [word] {word} 'word'
"""

_TABLE = bytes(
    c if c in b" \t\n\v\f\r" else ord("a") if 97 <= c <= 122 else ord("A") if 65 <= c <= 90
    else ord("0") if 48 <= c <= 57 else ord("u") if c >= 128 else ord("~") if c < 32 or c == 127 else c
    for c in range(256))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ---------------------------------------------------------------- base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        done = m.end() if m else at + 1  # nothing before a sign that failed can match
        if m:
            yield first, done
        at = text.find("@", done)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() > 15:
            digits = _only_digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_only_digits(m.group())) <= 15]


# ---------------------------------------------------------------- shapes and the field


def _shapes(text: str) -> list[bytes]:
    return utf8(text).translate(_TABLE).split()


_OUTER = b".,;:!?\"'#*$%&=|<>"


def _collapse(shape: bytes) -> str:
    return re.sub(rb"(.)\1+", rb"\1", shape).decode()


def _digit_bucket(n: int) -> str:
    for top in (0, 1, 2, 3, 4, 6, 7, 9, 11, 12, 15, 16, 19):
        if n <= top:
            return str(top)
    return "more"


def word_features(shape: bytes) -> tuple[list[str], list[str]]:
    """(features of the word itself, what its neighbours see of it)."""
    n = shape.count(b"0")
    shape = shape[:SHAPE]
    core = shape.strip(_OUTER)
    plain = "bare" if not core else "word" if not core.strip(b"aAu") else "number" if not core.strip(b"0") \
        else "mixed"
    runs = re.sub(rb"0+", lambda m: str(len(m.group())).encode(), re.sub(rb"[aAu]+", b"a", core))
    seen = [plain, f"core {_collapse(core)}", f"digits {_digit_bucket(n)}"]
    if n:
        seen.append(f"runs {runs.decode()}")
    own = [*seen, "any", f"first {shape[:1].decode()}", f"last {shape[-1:].decode()}"]
    if b"@" in core[1:-1]:
        own.append("inner @")
    if n and not core.strip(b"0()+-./"):
        own.append("number signs")
    if any(b in core for b in (b"[", b"(")) and core.count(b"a") > 4:
        own.append("inner bracket")
    if core.count(b":") > 1 and not core.strip(b"0aA:"):
        own.append("colons")
    return own, seen


class Field:
    """Weights of the trained field: what a word, the word before and the word after
    say for each label, and the transitions.  Both ends of a text count as O."""

    def __init__(self, weights: dict[str, np.ndarray], moves: np.ndarray):
        self.weights, self.moves = weights, moves
        # the most that the two moves around a label can hold against O there
        self.regret = (moves - moves[:, :1]).max(axis=0) + (moves - moves[:1]).max(axis=1)

    def scores(self, shape: bytes) -> np.ndarray:
        """3 x labels: as the word itself, as the one before, as the one after."""
        own, seen = word_features(shape)
        return np.stack([sum((self.weights[f] for f in (f"{p} {f}" for f in names) if f in self.weights),
                             np.zeros(len(LABELS)))
                         for p, names in (("own", own), ("before", seen), ("after", seen))])


def parse_labelled(lines: str) -> list[tuple[list[bytes], list[int]]]:
    """Marked lines -> shapes of the words and their labels."""
    out = []
    for line in lines.strip().split("\n"):
        shapes, labels = [], []
        for k, part in enumerate(re.split(r"<((?:email|ip|card|phone)\|[^<>]*)>", line)):
            kind, _, text = part.rpartition("|") if k % 2 else ("", "", part)
            # punctuation right behind a mark belongs to its last word
            if not k % 2 and shapes and text and not text[0].isspace():
                glued, _, text = text.partition(" ")
                shapes[-1] += _shapes(glued)[0]
            words = _shapes(text)
            shapes += words
            labels += [LABELS.index(f"{'I' if j else 'B'}-{kind}") if kind else 0 for j in range(len(words))]
        if shapes:
            out.append((shapes, labels))
    return out


def _marginals(e: np.ndarray, moves: np.ndarray):
    """(log of the sum over all paths, marginals, expected moves) of one text."""
    n, k = e.shape

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    ahead, back = np.empty((n, k)), np.empty((n, k))
    ahead[0] = moves[0] + e[0]
    for t in range(1, n):
        ahead[t] = lse(ahead[t - 1][:, None] + moves, 0) + e[t]
    back[-1] = moves[:, 0]
    for t in range(n - 2, -1, -1):
        back[t] = lse(moves + (e[t + 1] + back[t + 1])[None], 1)
    whole = float(lse(ahead[-1] + back[-1], 0))
    p = np.exp(ahead + back - whole)
    pair = np.zeros((k, k))
    if n > 1:
        pair = np.exp(ahead[:-1, :, None] + moves[None] + (e[1:] + back[1:])[:, None] - whole).sum(axis=0)
    pair[0] += p[0]
    pair[:, 0] += p[-1]
    return whole, p, pair


def loss_and_gradient(rows, w: np.ndarray, moves: np.ndarray):
    """Negative log-likelihood with a ridge, and its gradients; ``rows`` hold per text
    (features of each word as 0/1 rows, labels)."""
    loss, dw, dm = 0.0, np.zeros_like(w), np.zeros_like(moves)
    for x, y in rows:
        e = x @ w
        whole, p, pair = _marginals(e, moves)
        path = np.concatenate([[0], y, [0]])
        loss += whole - e[np.arange(len(y)), y].sum() - moves[path[:-1], path[1:]].sum()
        p[np.arange(len(y)), y] -= 1
        dw += x.T @ p
        dm += pair
        np.subtract.at(dm, (path[:-1], path[1:]), 1)
    loss += RIDGE / 2 * (w ** 2).sum() + MOVE_RIDGE / 2 * (moves ** 2).sum()
    return loss, dw + RIDGE * w, dm + MOVE_RIDGE * moves


@lru_cache(maxsize=4)
def train(labelled: str = LABELLED) -> Field:
    """The field for a table of marked lines; the same weights at every call."""
    texts = parse_labelled(labelled)
    index: dict[str, int] = {}
    marked = []
    for shapes, y in texts:
        both = [word_features(s) for s in shapes]
        marked.append(([[f"own {f}" for f in own]
                        + [f"before {f}" for f in (both[t - 1][1] if t else [])]
                        + [f"after {f}" for f in (both[t + 1][1] if t + 1 < len(both) else [])]
                        for t, (own, _) in enumerate(both)], y))
        for names in marked[-1][0]:
            for f in names:
                index.setdefault(f, len(index))
    rows = []
    for names, y in marked:
        x = np.zeros((len(y), len(index)))
        for t, one in enumerate(names):
            x[t, [index[f] for f in one]] = 1
        rows.append((x, np.array(y)))
    w, moves = np.zeros((len(index), len(LABELS))), np.zeros((len(LABELS),) * 2)
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, moves)]
    for step in range(1, STEPS + 1):  # Adam, whole table a step
        _, *grads = loss_and_gradient(rows, w, moves)
        for v, g, s in zip((w, moves), grads, state, strict=True):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            v -= RATE * (1 - step / (STEPS + 1)) * (s[0] / (1 - 0.9 ** step)) / (
                np.sqrt(s[1] / (1 - 0.99 ** step)) + 1e-8)
    return Field({f: w[k] for f, k in index.items()}, moves)


# ---------------------------------------------------------------- decoding


def _viterbi(e: np.ndarray, starts: np.ndarray, ends: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels of the runs ``e[starts:ends]``, each between two words labelled O."""
    out = np.zeros(len(e), np.int8)
    order = np.argsort(starts - ends, kind="stable")  # longest first
    while len(order):
        longest = int(ends[order[0]] - starts[order[0]])
        take = order[:max(1, VITERBI_WORDS // longest)]
        order = order[len(take):]
        first, size = starts[take], ends[take] - starts[take]
        best = moves[0] + e[first]
        back = np.zeros((longest, len(take), len(LABELS)), np.int8)
        live = len(take)
        last = best.copy()
        for t in range(1, longest):
            live = int(np.searchsorted(-size, -t, side="left"))  # runs longer than t come first
            way = best[:live, :, None] + moves
            back[t, :live] = way.argmax(axis=1)
            best = way.max(axis=1) + e[first[:live] + t]
            last[:live] = best
        label = (last + moves[:, 0]).argmax(axis=1)
        at = np.arange(len(take))
        for t in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, side="left"))
            out[first[:live] + t] = label[:live]
            label[:live] = back[t, at[:live], label[:live]]
    return out


def label_words(field: Field, ids: np.ndarray, cuts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Best label of every word.  ``ids`` are shape numbers, ``cuts`` the first words of
    texts, ``table`` the scores of each shape (shapes x 3 x labels)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int8)
    none = len(table)  # stands for the outside of a text
    table = np.concatenate([table, np.zeros((1, *table.shape[1:]))])
    before, after = np.full(n, none), np.full(n, none)
    before[1:], after[:-1] = ids[:-1], ids[1:]
    first = cuts[cuts < n]
    before[first] = none
    after[first[first > 0] - 1] = none
    lead = (table[:, :, :1] - table[:, :, 1:])  # of O, for each other label
    floor = lead.min(axis=2)
    floor[:, 0] = (lead[:, 0] - field.regret[1:]).min(axis=1)
    open_ = np.flatnonzero(floor[ids, 0] + floor[before, 1] + floor[after, 2] <= 1e-9)
    e = table[ids[open_], 0] + table[before[open_], 1] + table[after[open_], 2]
    still = ((e[:, :1] - e[:, 1:]) - field.regret[1:]).min(axis=1) <= 1e-9
    open_, e = open_[still], e[still]
    out = np.zeros(n, np.int8)
    if len(open_):
        text = np.searchsorted(cuts, open_, side="right")
        fresh = np.append(True, (np.diff(open_) > 1) | (np.diff(text) > 0))
        starts = np.flatnonzero(fresh)
        out[open_] = _viterbi(e, starts, np.append(starts[1:], len(open_)), field.moves)
    return out


_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_NUMBER = re.compile(r"[0-9 \t\n().+/-]+")
_AT = re.compile(r"[^\s@]+?\s?(?:@|\[at\]|\(at\))\s?[^\s@]+?(?:\.|\[dot\]|\(dot\)|\[\.\])[^\s@]+", re.I)
_PARTS = re.compile(r"\s*(?:\[\.\]|\(\.\)|\.)\s*")


def _holds(kind: str, value: str) -> bool:
    """The exact check of a span that the field has found."""
    digits = _only_digits(value)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and _NUMBER.fullmatch(value) is not None
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and all(not c.isalpha() for c in value)
    if kind == "email":
        return _AT.fullmatch(value) is not None
    parts = _PARTS.split(value)
    if len(parts) == 4 and all(p and p.isascii() and p.isdigit() and _small(p) for p in parts):
        return True
    try:
        return ipaddress.ip_address(value).version == 6
    except ValueError:
        return False


def _added(text: str, labels: np.ndarray, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Checked spans of the field's labels that touch no base span."""
    places = [m.span() for m in _WORD.finditer(text)]
    taken = sorted((a, b) for _, a, b in base)
    out, t = [], 0
    edges = np.array([a for a, _ in taken]), np.maximum.accumulate(np.array([b for _, b in taken] or [0]))
    while t < len(labels):
        if not labels[t]:
            t += 1
            continue
        kind, u = (labels[t] - 1) // 2, t + 1
        while u < len(labels) and labels[u] == 2 + 2 * kind:  # I of the same kind
            u += 1
        a, b = places[t][0], places[u - 1][1]
        t = u
        keep = {"phone": "+(", "ip": ":"}.get(KINDS[kind], "")
        while a < b and text[a] in _TRIM and text[a] not in keep:
            a += 1
        while a < b and text[b - 1] in _TRIM:
            b -= 1
        k = int(np.searchsorted(edges[0], b))  # base spans that start before the end
        if a < b and not (k and edges[1][k - 1] > a) and _holds(KINDS[kind], text[a:b]):
            out.append((KINDS[kind], a, b))
    return out


def find_spans(texts: list[str | None], field: Field) -> list[list[tuple[str, int, int, bool]]]:
    """Per text (kind, start, end, base), by kind, then start; code points, end exclusive."""
    number: dict[bytes, int] = {}
    ids, cuts, shaped = [], [], []
    for text in texts:
        shape = _shapes(text)
        cuts.append(len(ids))
        ids += [number.setdefault(s, len(number)) for s in shape]
        shaped.append(len(shape))
    score = lru_cache(maxsize=1 << 16)(field.scores)
    table = np.stack([score(s) for s in number]) if number else np.zeros((0, 3, len(LABELS)))
    cuts = np.array(cuts, np.int64)
    labels = label_words(field, np.array(ids, np.int64), cuts, table)
    digit = np.array([b"0" in s or b"@" in s for s in number], bool)
    flagged = np.concatenate([[0], np.cumsum(digit[np.array(ids, np.int64)] if ids else [])])
    hit = np.concatenate([[0], np.cumsum(labels > 0)])
    out = []
    for text, a, n in zip(texts, cuts, shaped, strict=True):
        base = base_spans(text) if flagged[a + n] > flagged[a] else []
        more = _added(text, labels[a:a + n], base) if hit[a + n] > hit[a] else []
        spans = [(*s, True) for s in base] + [(*s, False) for s in more]
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def masked(text: str, spans) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first."""
    out, done = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
            done = b
        else:
            done = max(done, b)
    return "".join([*out, text[done:]])


SPAN = "struct<kind: string, start: int, stop: int, base: boolean>"


def find_personal_data(docs: DataFrame, labelled: str = LABELLED, with_text: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, found (spans by kind, then start), masked (the text with
    kinds in place of the spans; null unless ``with_text``): one row per row."""
    field = train(labelled)

    def run(batches):
        import pyarrow as pa

        kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())])
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            found = find_spans(texts, field)
            rows = [[dict(zip(("kind", "start", "stop", "base"), s, strict=True)) for s in f] for f in found]
            mask = [masked(t, f) if with_text and t is not None else None
                    for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(rows, pa.list_(kinds)), pa.array(mask, pa.string())],
                names=["doc_id", "found", "masked"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, found array<{SPAN}>, masked string")


def listed(base_only: bool = False) -> Column:
    """``found`` as text: kind:start:end, comma-joined."""
    spans = F.filter("found", lambda s: s["base"]) if base_only else F.col("found")
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))
