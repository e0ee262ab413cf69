"""Personal data: base patterns, and a semi-Markov conditional random field that adds whole spans they miss.

The base spans (email, ip, card, phone) are exact leftmost non-overlapping matches. The field scores candidate segments
of up to MOST tokens (blanks not counted) and LONGEST characters, and whole addresses with a spaced or spelled-out at sign, by
features of the whole span and its surroundings; a dynamic programme over each region of a line chooses boundaries and
kinds together. Regions are the stretches around digits, at signs and spelled-out at signs, as far as a segment may reach:
every segment must hold one, so nothing outside them can be chosen. A region of any length streams past: only segments that
score above ordinary text are kept, and the programme is solved and let go wherever none of them crosses. Weights are fitted by maximum likelihood on sentences
that are generated from a fixed seed, with look-alikes (dates, amounts, versions, identifiers) as ordinary text. A
segment that overlaps a base span is dropped; base spans always stay.

Defined cases: a null text is empty and has no spans; repeated rows give equal rows; an empty table gives an empty
result; other columns are ignored (the redacting form keeps the columns it is told to keep).
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_column, table

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int, int]  # start, kind, end

#: Tokens of a segment at most, blanks not counted, its characters, and its digits unless it has an at sign; whole addresses
#: may have more.
MOST, LONGEST, DIGITS = 20, 128, 20
#: Labels that a domain name can have (253 characters with a dot between any two), and characters of an address at most.
LABELS, LONGEST_ADDRESS = 127, 2048
#: Segments whose features are made at a time.
BLOCK = 4096

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is taken whole and from its start: any other start of the pattern in it fails alike
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")  # digits with single marks between, as the pattern takes them
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({] ?at ?[\])}]")
_MARK = re.compile(r"[0-9]+|@|[\[({] ?at ?[\])}]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.")
# up to MOST tokens of a line with the blanks before them; the same read backwards, as every token is a run of one class
_REACH = re.compile(r"(?:[^\S\n]*+(?:[^\W\d_]++|[0-9]++|\S)){0,%d}" % MOST)
_AT = re.compile(r"@|[\[({] ?at ?[\])}]")
_LABEL = re.compile(r" ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]+")
_SPELLED_DOT = re.compile(r" ?[\[({] ?dot ?[\])}]")
_FIRST_LABEL = re.compile(r" ?[A-Za-z0-9-]+")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = (2 * n - 9 if n > 4 else 2 * n for n in map(int, digits[-2::-2]))
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """All base spans, by start and then kind."""
    out: list[Span] = []
    last = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, 0, m.end()))
            last = m.end()
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() < 38 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- the semi-Markov field

_EMAIL_SHAPES = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    re.compile(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(?: ?\. ?[A-Za-z0-9-]+)+"),
    re.compile(r"[A-Za-z0-9._%+-]+ ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]+(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]+)+"),
]
_IP_SHAPES = [re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"), re.compile(r"[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}")]
_CARD_SHAPES = [re.compile(r"[0-9]{4}(?:[ .·_/-]{1,3}[0-9]{4}){3}"), re.compile(r"[0-9]{4}[ ./-][0-9]{6}[ ./-][0-9]{5}")]
_PHONE_SHAPES = [
    re.compile(r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}"),
    re.compile(r"(?:1|001|0049|0033|0034)[ .-]\(?[0-9]{1,3}\)?(?:[ .-][0-9]{2,4}){2,4}"),
    re.compile(r"\+ ?[0-9]{1,3}(?:[ ./()-]{0,2}[0-9]{2,4}){2,5}"),
    re.compile(r"0[0-9](?:[ .-][0-9]{2}){4}"),
]
_DATE = re.compile(r"[0-9]{1,4}([-/.])[0-9]{1,2}\1[0-9]{1,4}")
_NUMBER = re.compile(r"[0-9]{1,3}(?:[ ,.][0-9]{3})+(?:[.,][0-9]{1,2})?|[0-9]+[.,][0-9]+")
_SHAPES = [s.fullmatch for s in (*_EMAIL_SHAPES, *_IP_SHAPES, *_CARD_SHAPES, *_PHONE_SHAPES, _DATE, _NUMBER)]
_DIGITS = re.compile("[0-9]+")
_CUES = [re.compile(x, re.IGNORECASE) for x in (r"mail|contact|write", r"\bip\b|host|address|server", r"card|visa|credit|payment", r"tel|phone|call|fax|mobile", r"order|ref|id|no\.?|version|isbn|total|date|v\.?$")]
_EDGES = ((0, 6), (7, 8), (9, 9), (10, 10), (11, 11), (12, 12), (13, 15), (16, 16), (17, 19), (20, 99))
FEATURES = 1 + len(_SHAPES) + len(_EDGES) + len(_CUES) + 17
_NUMBER_BEFORE, _NUMBER_AFTER = re.compile(r"[0-9][0-9A-Za-z]* ?$"), re.compile(r" ?[0-9]{2}")


def _features(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """(spans, FEATURES) features of whole candidate spans and of what stands beside them; spans in order of start."""
    rows, at, cues = [], -1, []
    for start, end in spans:
        if start != at:
            cue, at = text[max(0, start - 20) : start], start
            cues = [*(bool(c.search(cue)) for c in _CUES), bool(_NUMBER_BEFORE.search(cue))]
        span = text[start:end]
        parts = _DIGITS.findall(span)
        n = sum(map(len, parts))
        before, after = text[start - 1 : start], text[end : end + 1]
        ip = len(parts) == 4 and span.count(".") == 3 and all(map(_small, parts))
        chars = set(span)
        letters, seps = any(map(str.isalpha, chars)), sum(not c.isalnum() for c in chars)
        long = 12 <= n <= 19
        good = long and luhn("".join(parts))
        rows.append(bytes((
            True, *(s(span) is not None for s in _SHAPES), *(a <= n <= b for a, b in _EDGES), *cues,
            good, long and not good, ip, "@" in span, letters, seps > 2, n == len(span),
            before.isalnum() or after.isalnum(), before != "" and before in ".-/+@_#$€£:", after != "" and after in "-/@_%€:" or after == "." and text[end + 1 : end + 2].isalnum(),
            span[0] in "+(" or span[0].isalnum(), not span[-1].isalnum(), len(parts) > 5, " " in span and letters,
            _SPELLED_DOT.match(text, end) is not None, _NUMBER_AFTER.match(text, end) is not None,
        )))
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, FEATURES).astype(np.float64)


def _addresses(text: str, low: int, high: int) -> list[tuple[int, list[int]]]:
    """Starts of the addresses of any length around the at signs, each with the ends of its labels from the second on."""
    out = []
    for m in _AT.finditer(text, low, high):
        start = m.start() - (text[m.start() - 1 : m.start()] == " ")
        before = start
        least = max(low, before - LONGEST_ADDRESS)
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        upto = min(high, start + LONGEST_ADDRESS)
        label = _FIRST_LABEL.match(text, m.end(), upto)
        if start == before or not label:
            continue
        ends: list[int] = []
        while len(ends) < LABELS - 1 and (label := _LABEL.match(text, label.end(), upto)):
            ends.append(label.end())
        if ends:
            out.append((start, ends))
    return out


def _regions(text: str) -> list[tuple[int, int]]:
    """Stretches of lines within MOST tokens of a trigger, or within an address."""
    out: list[list[int]] = []
    for m in _MARK.finditer(text):
        high = _REACH.match(text, m.end()).end()
        if out and m.start() <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
            continue
        # tokens are read backwards from the mark, to the line's start or the region before at most
        least = out[-1][1] if out else 0
        least = max(text.rfind("\n", least, m.start()) + 1, least)
        low = m.start() - _REACH.match(text[least : m.start()][::-1]).end()
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    if not _AT.search(text):
        return [(low, high) for low, high in out]
    whole = sorted([*out, *([start, ends[-1]] for start, ends in _addresses(text, 0, len(text)))])
    out = whole[:1]
    for low, high in whole[1:]:
        if low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def _tokens(text: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the tokens of a region (one more than tokens), and the first trigger at or after each edge."""
    edges = np.concatenate([[low], np.fromiter((m.end() for m in _TOKEN.finditer(text, low, high)), np.int64)])
    marks = np.concatenate([np.fromiter((m.start() for m in _TRIGGER.finditer(text, low, high)), np.int64), [high]])
    return edges, marks[np.searchsorted(marks, edges).clip(max=len(marks) - 1)]


def _candidates(text: str, low: int, high: int, edges: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Segments (first token, token after the last, start, end) that hold a trigger, by their first token."""
    whole: dict[int, list[int]] = {}
    for a, after in _addresses(text, low, high):
        while a < after[0] and not (text[a].isalnum() and edges[np.searchsorted(edges, a)] == a):
            a += 1
        i = int(np.searchsorted(edges, a))
        if edges[i] == a:
            known = whole.setdefault(i, [])
            known += [j for b in after if text[b - 1].isalnum() and edges[j := int(np.searchsorted(edges, b))] == b and j not in known]
    n = len(edges) - 1
    at, first = 0, 0  # a stretch of the tokens as plain lists
    a_of: list[int] = []
    for i in range(n):
        if i + 2 * MOST + 2 > at + len(a_of) and at + len(a_of) < n + 1:
            at, first = i, i
            a_of = edges[i : i + BLOCK].tolist()
            live = (marks[i : i + BLOCK] < edges[np.minimum(np.arange(i + 1, i + len(a_of) + 1), n)]).tolist()
            blank = [text[a : a + 1].isspace() for a in a_of]
        k = i - first
        a = a_of[k]
        if blank[k] or text[a] in ",;:!?])}'\"":
            continue
        holds = False
        weight = count = 0
        more, j = whole.get(i, ()), k
        while j < len(a_of) - 1 and i + j - k < n:
            b = a_of[j + 1]
            if b - a > LONGEST:
                break
            if not blank[j]:
                count += 1
                if count > MOST:
                    break
                holds |= live[j]
                weight += (b - a_of[j]) * live[j]
                if holds and b - a >= 7 and text[b - 1].isalnum() and (at + j + 1) not in more:
                    # seven digits, four with the dots of an address, or an at sign
                    if 7 <= weight <= DIGITS or (span := text[a:b]).count(".") >= 3 and 4 <= weight <= DIGITS or "@" in span or "at" in span:
                        yield i, at + j + 1, a, b
            j += 1
        for end in more:
            yield i, end, a, int(edges[end])


def _lattice(n: int, segments: list, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums over all segmentations of the tokens before, and from, each position."""
    starts, ends = np.asarray([s[0] for s in segments], int), np.asarray([s[1] for s in segments], int)
    best = np.logaddexp.reduce(scores, axis=1) if len(segments) else np.zeros(0)
    into: list[list[int]] = [[] for _ in range(n + 1)]
    out_of: list[list[int]] = [[] for _ in range(n + 1)]
    for k in range(len(segments)):
        into[ends[k]].append(k)
        out_of[starts[k]].append(k)
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, n + 1):
        k = into[t]
        ahead[t] = np.logaddexp.reduce([ahead[t - 1], *(ahead[starts[k]] + best[k])]) if k else ahead[t - 1]
    for t in range(n - 1, -1, -1):
        k = out_of[t]
        behind[t] = np.logaddexp.reduce([behind[t + 1], *(behind[ends[k]] + best[k])]) if k else behind[t + 1]
    return ahead, behind


def _examples(count: int, seed: int):
    """Generated sentences with their spans (start, kind, end)."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(pick("an", "er", "tion", "sch", "le", "os", "th", "ei", "ré", "ar") for _ in range(rng.integers(1, 4)))

    def card(good: bool) -> str:
        body = "4" + digits(14)
        last = next(str(k) for k in range(10) if luhn(body + str(k)) == good)
        return body + last

    def fours(x: str, sep: str) -> str:
        return sep.join(x[k : k + 4] for k in range(0, 16, 4))

    name = lambda: word().replace("é", "e") + pick("", ".", "_") + pick("", digits(2))
    plain = lambda: word().replace("é", "e")
    names = lambda: ".".join(plain() for _ in range(rng.integers(1, 4)))
    labels = lambda: [plain() + pick("", "", f"-{plain()}") for _ in range(rng.integers(1, 4))] + pick(["com"], ["org"], ["edu"], ["ac", "uk"], ["co", "uk"])
    byte = lambda: str(rng.integers(0, 256))
    shown = [
        lambda: (0, f"{name()}x@{pick('mail', 'post')}{digits(1)}.example.com"), lambda: (0, f"{name()}x [at] {pick('mail', 'post')} [dot] {pick('com', 'org', 'de')}"),
        lambda: (0, f"{name()}x (at) {pick('mail', 'post')}.{pick('com', 'org', 'fr')}"), lambda: (0, f"{name()}x @ {pick('mail', 'post')}.{pick('com', 'net')}"),
        lambda: (0, f"{names()}x [at] {' [dot] '.join(labels())}"), lambda: (0, f"{names()}x {pick('(at)', '[at]', '@')} {'.'.join(labels())}"),
        lambda: (1, ".".join(byte() for _ in range(4))), lambda: (1, "[.]".join(byte() for _ in range(4))),
        lambda: (2, card(True)), lambda: (2, fours(card(True), pick(" ", "-", ".", "  ", " - "))),
        lambda: (3, f"+{pick('1', '49', '33')} ({digits(3)}) 555-{digits(4)}"), lambda: (3, f"({digits(3)}) {digits(3)}-{digits(4)}"),
        lambda: (3, f"{digits(3)}-{digits(3)}-{digits(4)}"), lambda: (3, f"{digits(3)}.{digits(3)}.{digits(4)}"), lambda: (3, f"0{pick('1', '6')} {digits(2)} {digits(2)} {digits(2)} {digits(2)}"),
        lambda: (3, f"1-{digits(3)}-{digits(3)}-{digits(4)}"),
    ]
    hidden = [
        lambda: f"{rng.integers(1900, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}", lambda: f"{rng.integers(1, 29)}/{rng.integers(1, 13)}/{rng.integers(1990, 2030)}",
        lambda: f"${rng.integers(1, 999)},{digits(3)}.{digits(2)}", lambda: f"{digits(1)}.{digits(1)}.{digits(2)}", lambda: digits(int(rng.integers(1, 9))),
        lambda: fours(card(False), pick(" ", "-", ".")), lambda: card(False), lambda: digits(10), lambda: f"{digits(3)}-{digits(2)}-{digits(2)}", lambda: f"{byte()}.{byte()}.{byte()}",
        lambda: f"{300 + int(digits(2))}.{byte()}.{byte()}.{byte()}", lambda: f"{digits(2)}:{digits(2)}:{digits(2)}", lambda: f"{digits(3)},{digits(3)},{digits(3)}", lambda: f"{digits(5)} {digits(4)}",
        lambda: "".join(pick(*"0123456789abcdef") for _ in range(24)), lambda: f"@{word()}", lambda: f"{pick('DE', 'FR', 'GB', 'ES')}{digits(2)} {' '.join(digits(4) for _ in range(rng.integers(3, 6)))}{pick('', f' {digits(2)}')}", lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(13)}", lambda: f"v{digits(1)}.{digits(1)}.{digits(1)}.{digits(1)}-{word()}",
    ]
    for _ in range(count):
        text, gold = "", []
        for _ in range(rng.integers(1, 4)):
            text += " ".join(word() for _ in range(rng.integers(1, 5))) + pick(" ", " ", ", ", ": ")
            if rng.random() < 0.55:
                kind, value = pick(*shown)()
                text += pick("", "", ("mail ", "host ", "card ", "tel ")[kind])
                gold.append((len(text), kind, len(text) + len(value)))
            else:
                value = pick(*hidden)()
                text += pick("", "", "order ", "ref ", "no. ")
            text += value + pick(" ", " ", ". ", ", ")
        yield text + word(), gold


@lru_cache(maxsize=2)
def weights(count: int = 500, rounds: int = 4, seed: int = 3) -> np.ndarray:
    """(kinds, features), by stochastic gradient on the log likelihood of whole segmentations."""
    prepared = []
    for text, gold in _examples(count, seed):
        for low, high in _regions(text):
            edges, marks = _tokens(text, low, high)
            n, segments = len(edges) - 1, list(_candidates(text, low, high, edges, marks))
            if not segments:
                continue
            x = _features(text, [s[2:] for s in segments])
            y = np.zeros((len(segments), len(KINDS)))
            for k, (_, _, a, b) in enumerate(segments):
                for start, kind, end in gold:
                    y[k, kind] += (a, b) == (start, end)
            prepared.append((n, segments, x, y))
    w = np.zeros((len(KINDS), FEATURES))
    w[:, 0] = -3
    grown = np.full_like(w, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for k in rng.permutation(len(prepared)):
            n, segments, x, y = prepared[k]
            scores = x @ w.T
            ahead, behind = _lattice(n, segments, scores)
            i, j = np.asarray([s[:2] for s in segments]).T
            p = np.exp(scores + (ahead[i] + behind[j] - ahead[n])[:, None])
            g = (p - y).T @ x + 1e-3 * w
            grown += g * g
            w -= 0.4 * g / np.sqrt(grown)
    return w


def _best(kept: list[array]) -> Iterator[tuple[int, int, int]]:
    """The segments (start, kind, end) on the best path through the kept ones (first token, after, kind, score, start, end)."""
    first, after, kind, score, start, end = kept
    low, count = min(first), max(after) - min(first)
    ending = sorted(range(len(after)), key=after.__getitem__)
    best, back, at = [0.0] * (count + 1), array("q", [-1]) * (count + 1), 0
    for t in range(1, count + 1):
        best[t] = best[t - 1]
        while at < len(ending) and after[k := ending[at]] - low == t:
            if best[first[k] - low] + score[k] > best[t]:
                best[t], back[t] = best[first[k] - low] + score[k], k
            at += 1
    t = count
    while t:
        k = back[t]
        if k < 0:
            t -= 1
        else:
            yield start[k], kind[k], end[k]
            t = first[k] - low


def added_spans(text: str, base: list[Span], w: np.ndarray) -> list[Span]:
    """Segments on the best path that overlap no base span."""
    out: list[Span] = []
    starts, ends = array("q"), array("q")  # the base spans as stretches apart
    for a, _, b in base:
        if starts and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b) - 1
        return k < 0 or ends[k] <= a

    new = lambda: [array(t) for t in "qqqdqq"]
    for low, high in _regions(text):
        kept, upto, block = new(), 0, []

        def scored() -> None:
            """Keep the segments of the block that score above ordinary text: others are on no best path."""
            nonlocal upto
            scores = _features(text, [s[2:] for s in block]) @ w.T
            for (i, j, a, b), k, value in zip(block, scores.argmax(1).tolist(), scores.max(1).tolist(), strict=True):
                if value > 0:
                    for column, x in zip(kept, (i, j, k, value, a, b), strict=True):
                        column.append(x)
                    upto = max(upto, j)
            block.clear()

        for s in _candidates(text, low, high, *_tokens(text, low, high)):
            if len(block) >= BLOCK:
                scored()
            if not block and kept[0] and upto <= s[0]:
                out += _best(kept)
                kept = new()
            if free(s[2], s[3]):
                block.append(s)
        if block:
            scored()
        if kept[0]:
            out += _best(kept)
    return sorted(out)


def all_spans(text: str, w: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of one whole text."""
    if not text or not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, w))


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns with counts, digest of the base spans, and all spans as text."""
    w = weights()

    def make():
        def work(texts: list[str | None]) -> list[list]:
            found = [all_spans(text or "", w) for text in texts]
            counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(len(KINDS))]
            sha = [hashlib.sha256(spell(base).encode()).hexdigest() for base, _ in found]
            return [*counts, sha, [spell(every) for _, every in found]]

        return work

    return map_column(docs, keep, "text", make, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the name of its first span's kind."""
    out, at, upto = [], 0, -1
    for start, kind, end in spans:
        if start >= upto:
            if upto >= 0:
                at = upto
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            upto = end
        upto = max(upto, end)
    return "".join(out) + text[max(upto, 0) :]


def redact(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, then the text after redaction; a null text stays null."""
    w = weights()

    def make():
        return lambda texts: [[text if not text else redacted(text, all_spans(text, w)[1]) for text in texts]]

    return map_column(docs.select(*keep, F.col("text").alias("of_text")), keep, "of_text", make, "text string")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), ["doc_id"])
