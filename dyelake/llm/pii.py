"""Personal data: fixed patterns, and a character tagger that adds what they miss.

The patterns give the base spans. A BiLSTM-CRF learns from labelled spans: those of the patterns in a bounded sample of windows of the texts, and
written-out forms that no pattern takes (numbers in other groupings, spelled-out addresses, keys and identity numbers), whose spans are known because they
were set into such windows. No pattern labels what the tagger adds: a window with a long run of letters and digits, which may be a key and has no
label, teaches nothing. The tagger reads every place of every text that could hold personal data: each digit, @ sign, bracketed "at" or "dot",
" dot " and unbroken run of 16 or more key characters, with what surrounds it. A text is read in overlapping windows, and where they overlap, the window in
which a character lies most centrally decides, so that spans across window edges come out whole.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dyelake.llm.char_tagger import Tagger, encode
from dyelake.llm.text import rows_of, texts_of

#: Kinds of the patterns, and those that only the tagger finds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn")
WINDOW, STRIDE = 64, 32
EPOCHS = 12

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]*")
# A run of digits that doesn't lead to a match leads to none from its middle either: no second look.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What may be a key that has no label: left out of learning.
_UNLABELLED = re.compile(r"(?=[+/_-]*[A-Za-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}|[0-9][A-Za-z0-9+/_-]*[A-Za-z][A-Za-z0-9+/_-]{10,}")
#: The shortest run without a digit that may be a key.
RUN = 16
_PLACE = re.compile(r"(?i)[0-9@]|[\[({<](?:at|dot)[\])}>]| dot |[A-Za-z+/_-]{%d,}" % RUN)
_GATE, _KEY = np.zeros(256, bool), np.zeros(256, bool)
_GATE[0x30:0x3A] = _GATE[0x40] = True
_KEY[[*range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_-"]] = True


def _gated(data: np.ndarray) -> np.ndarray:
    """Bytes at which a place to read begins, or lies: those of what _PLACE matches."""
    d = np.concatenate((data, np.zeros(4, np.uint8)))
    low = d | 0x20
    opens, shuts = np.isin(d, np.frombuffer(b"([{<", np.uint8)), np.isin(d, np.frombuffer(b")]}>", np.uint8))
    at = opens[:-4] & (low[1:-3] == 0x61) & (low[2:-2] == 0x74) & shuts[3:-1]
    space = d == 0x20
    dot = ((space[:-4] & space[4:]) | (opens[:-4] & shuts[4:])) & (low[1:-3] == 0x64) & (low[2:-2] == 0x6F) & (low[3:-1] == 0x74)
    flags = _GATE[data] | at[: len(data)] | dot[: len(data)]
    if len(data) >= RUN:
        held = np.concatenate(([0], np.cumsum(_KEY[data])))
        flags[: len(data) - RUN + 1] |= held[RUN:] - held[:-RUN] == RUN
    return flags


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """One look at each @ sign: the longest run of name characters before it, after the last match."""
    floor, at = 0, text.find("@")
    while at >= 0:
        low = at - len(_LOCAL_BACK.match(text[at - 1 : floor - 1 if floor else None : -1] if at > floor else "")[0])
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            floor = domain.end()
        else:
            # Runs never reach over an @ sign.
            floor = max(floor, at + 1)
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' spans, in code points, by kind as listed and then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


def windows(text: str) -> list[int]:
    """Starts of overlapping windows that cover each place of the text that is read, with what surrounds it."""
    starts: list[int] = []
    for m in _PLACE.finditer(text):
        for k in range(max(0, m.start() - 40) // STRIDE, (m.end() + 7) // STRIDE + 1):
            if not starts or starts[-1] < k * STRIDE:
                starts.append(k * STRIDE)
    return starts


def _tags(start: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        for i in range(max(a, start), min(b, start + WINDOW)):
            out[i - start] = 1 + 2 * k + (i > a)
    return out


def written_out(rng: random.Random) -> tuple[str, str | None]:
    """A form that the patterns don't take, with its kind, or one that only looks like personal data (None)."""
    hexed, upper, lower = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    mixed = upper + lower + "0123456789"
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    chars = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    word = lambda: chars(rng.randint(3, 8), "abcdefghilmnoprstuwyk")
    byte, area = lambda: str(rng.randint(0, 255)), lambda: f"{rng.randint(2, 9)}{digits(2)}"

    def card(mark: str) -> str:
        while not _luhn(n := f"{rng.randint(3, 6)}{digits(15)}"):
            pass
        return mark.join(n[i : i + 4] for i in range(0, 16, 4))

    name = rng.choice((word(), f"{word()}.{word()}", f"{word()}{digits(rng.randint(1, 3))}", f"{word()}_{word()}", f"{digits(2)}{word()}", f"{word()}-{word()}"))
    host, end = rng.choice((word(), word(), f"{word()}-{word()}", f"{word()}{digits(1)}")), rng.choice(("com", "org", "net", "edu", "de", chars(2, lower), chars(3, lower), chars(4, lower)))
    quote = rng.choice(('"', "'", ""))
    gap = rng.choice(("", " "))
    # Groups of digits are what counts, whatever stands between them.
    some = rng.choice(("", "", " ")).join(("", rng.choice("-./_,;+*~#=&!"), rng.choice(("", " "))))
    bracketed = lambda said: rng.choice(("[{}]", "({})", "{{{}}}", "<{}>")).format(said)
    at, dot = rng.choice((f"{gap}{bracketed('at')}{gap}",) * 3 + (" at ", " at ", " at ", " at ", " AT ", f"{gap}{bracketed('@')}{gap}", "@ ")), rng.choice((".", ".", " dot ", " dot ", f"{gap}{bracketed('dot')}{gap}", " DOT ", " . "))
    if at.strip().isalpha() and "d" not in dot.lower():
        dot = " dot "
    spelled = f"{name}{at}{host}{dot}{rng.choice(('', '', f'{word()}{dot}'))}{end}"
    first, mark = rng.choice(("", "", "", "1 ", "1-", "1-", "1.")), rng.choice(("-", "-", "-", ".", " ", " - ", some, some))
    lead = rng.choice((f"({area()}) ", f"({area()})", f"{area()}-", f"{area()}.", f"{area()} ", f"{area()}{mark}", f"{area()}{some}", f"{{{area()}}} ", f"<{area()}>{mark}"))
    phone = rng.choice((f"{first}{lead}{digits(3)}{mark}{digits(4)}",) * 8 + (f"({area()}) {digits(3)}-{digits(4)}", f"{area()}-{digits(3)}-{digits(4)}", f"0{digits(2)} {digits(4)} {digits(4)}"))
    word_of = rng.choice(("token", "api_key", "apikey", "secret", "password", "passwd", "pwd", "access_key", "key"))
    value = chars(rng.randint(12, 44), rng.choice((hexed, hexed, mixed, mixed + "+/_-", lower + "0123456789", upper + lower)))
    key = rng.choice((f"{word_of}{rng.choice((' = ', '=', ': ', ':'))}{quote}{value}{quote}",) * 3 + (f"AKIA{chars(16, upper + '0123456789')}", f"ghp_{chars(36, mixed)}", f"sk-{chars(32, mixed)}", chars(rng.choice((32, 40)), hexed)))
    address = rng.choice((*(m.join(byte() for _ in range(4)) for m in ("[.]", " . ", "(.)", "[dot]", " [.] ", " dot ", ". ", "_", "-", " (dot) ")), ":".join(chars(4, hexed) for _ in range(8)), ":".join(chars(rng.randint(1, 4), hexed) for _ in range(rng.randint(4, 6))) + "::" + chars(4, hexed)))
    number = card(rng.choice((".", "/", "  ", " - ", ", ", some, some, some, some, some, some)))
    part = rng.choice(("-", "-", "-", " - ", " ", some, some, some))
    ssn = f"{rng.randint(1, 8)}{digits(2)}{part}{digits(2)}{part}{digits(4)}"
    said = word()
    odd = rng.choice((
        f"19{digits(2)}-0{rng.randint(1, 9)}-1{digits(1)}", f"{rng.randint(1, 9)}.{digits(1)}", f"{digits(2)}:{digits(2)}", f"${digits(3)}.{digits(2)}", digits(4), digits(rng.randint(1, 7)), f"{word()}@{word()}", f"v{digits(1)}.{digits(2)}.{digits(1)}",
        f"{digits(1)},{digits(3)},{digits(3)}", f"{word()}{digits(2)}", f"({digits(1)})", f"pages {digits(3)}-{digits(3)}", f"{digits(2)}.{digits(2)}.20{digits(2)}", f"{digits(2)}/{digits(2)}/{digits(4)}", f"{word()} at {word()}", f"the {word()} dot {word()}", f"CC BY-NC {digits(1)}.{digits(1)}",
        f"{word()}{word()}{word()}", f"{word()}-{word()}-{word()}", f"{word()}_{word()}_{word()}", f"/{word()}/{word()}/{word()}", f"{word_of}: {word()}", digits(16), digits(10),
        f"{said} " * rng.randint(2, 9), f"{word()}. At {word()}", f"{word()}, {word()} dot {word()}", f"{said}. {word()}", f"{digits(3)}-{digits(2)}", ", ".join(digits(2) for _ in range(4)), f"{digits(4)}-{digits(4)}",
    ))
    form, kind = rng.choice(((spelled, "email"), (spelled, "email"), (spelled, "email"), (phone, "phone"), (phone, "phone"), (key, "secret"), (key, "secret"), (address, "ip"), (number, "card"), (ssn, "ssn"), (odd, None), (odd, None), (odd, None)))
    return (form.upper() if kind in ("secret", "email", None) and rng.random() < 0.15 else form), kind


def value_of(form: str, kind: str | None) -> tuple[int, int]:
    """Where in a form its span is: of an assigned key the value, else all."""
    m = re.search(r"""[=:]\s*["']?([A-Za-z0-9+/_-]{12,})["']?$""", form) if kind == "secret" else None
    return m.span(1) if m else (0, len(form))


def _sampled(docs: DataFrame, most_docs: int, most_windows: int) -> list:
    """(line, tags) of windows of about ``most_docs`` documents, cut where the texts are; ``most_windows`` rows at most, by a hash of the line."""
    share = min(1.0, most_docs / max(1, docs.count()))
    some = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < 1_000_003 * share)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                starts = windows(text or "")
                spans = base_spans(text) if starts else []
                unsure = [m.span() for m in _UNLABELLED.finditer(text) if not any(m.start() < b and a < m.end() for _, a, b in spans)] if starts else []
                starts = [s for s in starts if not any(s < b and a < s + WINDOW for a, b in unsure)]
                if starts:
                    yield pa.RecordBatch.from_arrays([pa.array([text[s : s + WINDOW] for s in starts]), pa.array([_tags(s, spans).astype(np.uint8).tobytes() for s in starts], pa.binary())], names=["line", "tags"])

    lines = texts_of(some, "text").mapInArrow(cut, "line string, tags binary").distinct()
    return lines.orderBy(F.xxhash64("line"), "line", "tags").limit(most_windows).collect()


def learn(docs: DataFrame, most_docs: int = 3000, most_windows: int = 1500, forms: int = 9000, seed: int = 3) -> Tagger:
    """A tagger trained on windows of about ``most_docs`` documents, and ``forms`` written-out forms set into such windows.

    Documents are drawn by a hash of their text, windows by one of what they hold, wherever they lie in a text; ``most_windows`` bounds
    what comes to the driver. Equal windows count once.
    """
    rng = random.Random(seed)
    ids, tags, plain = [], [], []
    for r in _sampled(docs, most_docs, most_windows):
        ids.append(encode(r["line"], WINDOW))
        tags.append(np.frombuffer(r["tags"], np.uint8).astype(np.int64))
        plain.append(re.sub(r"\S*[0-9@]\S*", " ", r["line"]))
    for _ in range(forms):
        line, spans = planted(rng, plain)
        ids.append(encode(line, WINDOW))
        tags.append(_tags(0, spans))
    tagger = Tagger(1 + 2 * len(KINDS))
    tagger.train(np.stack(ids), np.stack(tags), epochs=EPOCHS, batch=128, rate=0.015)
    return tagger


def planted(rng: random.Random, plain: list[str], length: int = WINDOW) -> tuple[str, list[tuple[str, int, int]]]:
    """A line of ``length`` with a written-out form somewhere in one of the plain lines, and its spans: a part of the form where it is cut off."""
    form, kind = written_out(rng)
    around = rng.choice(plain) if plain else "so it was said, and then "
    cut = rng.randint(0, len(around))
    before, after = around[:cut].rstrip(), around[cut:].lstrip()
    before = f"{before} " if before else ""
    end = rng.choice((" ", " ", " ", ". ", ", ", "; ", "!! ", "\n"))
    low, high = value_of(form, kind)
    line = before + form + end + after
    # Windows begin anywhere, also inside a form.
    shift = rng.randint(0, max(0, len(before) + len(form) - 8)) if rng.random() < 0.4 else max(0, len(before) + len(form) - length)
    spans = [(kind, max(0, len(before) + low - shift), len(before) + high - shift)] if kind else []
    return line[shift : shift + length], [s for s in spans if s[1] < min(length, s[2])]


def tagged_spans(tagger: Tagger, texts: list[str], sure: float = 0.6) -> list[list[tuple[str, int, int]]]:
    """The tagger's spans of each text, of windows decoded together and reconciled by text."""
    where = [(n, s) for n, text in enumerate(texts) for s in windows(text)]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    places: dict[int, dict[int, tuple]] = {}
    for k in range(0, len(where), 512):
        block = where[k : k + 512]
        path, chance = tagger.decode(np.stack([encode(texts[n][s : s + WINDOW], WINDOW) for n, s in block]))
        for (n, s), row, prob in zip(block, path, chance, strict=True):
            own = places.setdefault(n, {})
            for i in np.flatnonzero(row).tolist() + np.flatnonzero(row == 0).tolist():
                centre = min(i, WINDOW - 1 - i)
                if s + i < len(texts[n]) and (s + i not in own or own[s + i][0] < centre):
                    own[s + i] = (centre, int(row[i]), float(prob[i]))
    for n, own in places.items():
        start = kind = None
        probs: list[float] = []
        last = -2
        for at in [*sorted(own), len(texts[n]) + 2]:
            tag, prob = own[at][1:] if at in own else (0, 0.0)
            if start is not None and (at != last + 1 or tag != 2 + 2 * kind):
                if np.mean(probs) >= sure:
                    out[n].append((KINDS[kind], start, last + 1))
                start = None
            if start is None and tag % 2:
                start, kind, probs = at, tag // 2, []
            if start is not None:
                probs.append(prob)
            last = at
    return out


#: The shortest span of a kind.
_SHORTEST = {"email": 6, "ip": 7, "card": 13, "phone": 7, "secret": 12, "ssn": 9}


def _worth(kind: str, text: str) -> bool:
    """Whether a span is long enough for its kind, and, of a card, whether its digits' checksum holds."""
    return len(text) >= _SHORTEST[kind] and (kind != "card" or _luhn(re.sub("[^0-9]", "", text)))


def personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, spans array of (kind, start, end, base)) of each row of ``docs`` (doc_id, text).

    Offsets are code points, the end exclusive. Base spans are the patterns': per kind the leftmost ones
    that don't overlap, less those that fail the kind's test. The tagger's spans are added where they
    overlap no base span, are long enough and, of cards, pass Luhn; base spans stay. Added spans may be of kinds that have no pattern:
    secret (keys, tokens and passwords) and ssn.

    Null and empty texts have no spans. Texts are read whole; work on a text is linear in its length.
    Repeated rows get equal answers, an empty table gives an empty one, other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(tagger)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for part in rows_of(column, fold=False):
                n = len(part)
                own: list[list] = [[] for _ in range(n)]
                rows = np.flatnonzero(part.per_row(_gated(part.data)))
                texts = [column[part.first + int(r)].as_py() for r in rows]
                for r, text, more in zip(rows, texts, tagged_spans(held.value, texts), strict=True):
                    base = base_spans(text)
                    added = [x for x in more if not any(x[1] < b and a < x[2] for _, a, b in base) and _worth(x[0], text[x[1] : x[2]])] if more else []
                    spans = [(*x, True) for x in base] + [(*x, False) for x in added]
                    own[r] = [dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.first, n), pa.array(own, kind)], names=["doc_id", "spans"])

    return texts_of(docs).mapInArrow(make, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind of base spans, their digest, all spans as text, and how many are the tagger's, of personal_data() rows."""
    base = F.filter("spans", lambda x: x["base"])
    number = lambda kind: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: ~x["base"])).cast("long").alias("n_added"),
    )
