"""Personal data: base patterns, and a character tagger for the same kinds written in other ways.

The tagger (``spotweave.llm.tagger``) is trained at the start of a call from
labelled spans: pieces of a bounded sample of the table (SAMPLE rows, PIECE
code points each), labelled by the base patterns, with further spans of each
kind set in, as the patterns know them and in other spellings (``of.55 (at)
mail4 dot example dot com``), and look-alikes that are no personal data.  Then
every whole text is cut into windows that overlap, all of them are tagged, and
``reconciled`` settles each document's spans over all its windows.  A tagged
span is reported if no base span overlaps it and an exact check of its kind
holds for it with the spelling undone; so a run of digits that only looks like
a card is left alone.

Edge cases: null text is empty; an empty text has no spans and the hash of the
empty string; repeated rows get equal results; long texts are tagged whole, a
window at a time; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.common import shared_dir
from spotweave.llm.tagger import PAD, Tagger, classes, train
from spotweave.llm.text import keep_freed, text_slices

KINDS = ["email", "ip", "card", "phone"]
#: Rows of the training sample, about, and code points of the piece taken of each.
SAMPLE, PIECE = 3000, 400
#: Training windows, their code points, steps, windows of a step and the first rate.
EXAMPLES, EXAMPLE, STEPS, BATCH, RATE = 14000, 112, 900, 64, 0.035
#: Code points of a window and by how many the next one overlaps it; windows tagged together; bytes of text handled at once.
WINDOW, OVERLAP, TOGETHER, SLICE = 1024, 64, 512, 1 << 21
#: What a tagged span has to be worth more than no span, in natural logarithms.
LEAST_GAIN = 2.0

#: Fixed patterns.  A match begins where a run of digits does, and digits once taken are not given back.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

#: Fixed spellings of the tagged forms.
AT = re.compile(r"\s*(?:[\[({<]\s*(?:at|@)\s*[\])}>]|\bat\b|@)\s*", re.I)
DOT = re.compile(r"\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|\bdot\b)\s*|\.", re.I)
EMAIL_WHOLE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
#: Endings that an address spelled in plain words ("x at y dot com") has to have; those that are common words are left out.
ENDINGS = {"com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "co", "dev", "app", "ai", "eu", "uk", "us", "de", "fr", "es", "nl", "ch", "pl", "pt", "se", "dk", "fi", "ru", "jp", "cn", "kr", "br", "mx", "ca", "au", "nz"}
CARD_WHOLE = re.compile(r"[0-9](?:[\x20._/‐-―-]{0,2}[0-9])+")
PHONE_WHOLE = re.compile(r"(?:(?:00[\x20.-]?)?[0-9]{1,3}[\x20.-])?(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_ip(text: str) -> bool:
    return all(int(p[-4:]) <= 255 and not p[:-3].strip("0") for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, in that order."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        # The run of characters before the sign, as far as the match before left them.
        begin = last + len(text[last:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if begin < at else None
        last = at + 1
        if m:
            out.append((0, begin, m.end()))
            last = m.end()
        at = text.find("@", last)
    for kind, pattern, fine in ((1, IP, _is_ip), (2, CARD, _is_card), (3, PHONE, lambda x: 9 <= len(_digits(x)) <= 15)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if fine(m.group())]
    return out


def spelled_out(kind: int, text: str) -> bool:
    """Whether ``text``, with its spelling undone, is what the kind's base rule asks for; phones without + have ten digits in threes and four."""
    if kind == 0:
        head, sign, tail = AT.sub("@", text, count=1).partition("@")
        plain = DOT.sub(".", head) + "@" + DOT.sub(".", tail)
        in_words = not re.search(r"[@\[\](){}<>]", text)
        return bool(sign) and EMAIL_WHOLE.fullmatch(plain) is not None and (not in_words or plain.rsplit(".", 1)[1].lower() in ENDINGS)
    if kind == 1:
        plain = DOT.sub(".", text)
        return IP.fullmatch(plain) is not None and _is_ip(plain)
    if kind == 2:
        return CARD_WHOLE.fullmatch(text) is not None and _is_card(text)
    return PHONE_WHOLE.fullmatch(text) is not None and 9 <= len(_digits(text)) <= 15


# Labelled examples --------------------------------------------------------------


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def _card(rng: random.Random) -> str:
    body = _number(rng, rng.choice([12, 14, 15, 15, 15, 18]))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _grouped(rng: random.Random, digits: str, gap: str) -> str:
    return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def made_span(rng: random.Random, kind: int, words: list[str]) -> str:
    """One span of a kind, half of them in a spelling that the base patterns don't know."""
    plain = rng.random() < 0.5
    if kind == 0:
        part = lambda: (re.sub("[^A-Za-z]", "", rng.choice(words)) or "box")[:12] + (_number(rng, rng.randrange(1, 3)) if rng.random() < 0.4 else "")
        names = [part() for _ in range(rng.choice([1, 1, 2, 3]))]
        hosts = [part() for _ in range(rng.choice([1, 1, 2]))] + [rng.choice(["com", "org", "net", "io", "de", "fr", "es"])]
        if plain:
            return rng.choice([".", "_", "-"]).join(names) + "@" + ".".join(hosts)
        at = rng.choice([" at ", " [at] ", " (at) ", "[at]", "(at)", " AT ", " {at} ", " @ ", "[@]"])
        dot = rng.choice([" dot ", " [dot] ", " (dot) ", "[dot]", "(dot)", " DOT ", "[.]", "(.)"])
        if at.strip() == "@" and rng.random() < 0.5:
            dot = "."
        return (dot if rng.random() < 0.5 else ".").join(names) + at + dot.join(hosts)
    if kind == 1:
        parts = [str(rng.randrange(256)) for _ in range(4)]
        return ("." if plain else rng.choice(["[.]", "(.)", " dot ", "[dot]", " [.] "])).join(parts)
    if kind == 2:
        digits = _card(rng)
        return rng.choice([digits, _grouped(rng, digits, rng.choice([" ", "-"]))]) if plain else _grouped(rng, digits, rng.choice([".", "_", "/", "  ", "–", " - "[1:]]))
    digits = [_number(rng, 3), _number(rng, 3), _number(rng, 4)]
    gap = rng.choice(["-", ".", " "])
    tail = rng.choice([f"({digits[0]}) {digits[1]}-{digits[2]}", gap.join(digits)])
    return rng.choice([f"+{rng.randrange(1, 99)} ", "+1 "]) + tail if plain else rng.choice(["", "", "1-", "1 ", "001 ", "00 44 "]) + tail


def look_alike(rng: random.Random, words: list[str]) -> str:
    """Something of digits, signs or words that is no personal data."""
    n = rng.randrange(1, 10**6)
    return rng.choice([
        f"{rng.randrange(1950, 2050)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}", f"{rng.randrange(24)}:{rng.randrange(60):02d}", f"{n}.{n % 97}", f"{n:,}", str(n), _number(rng, rng.randrange(7, 12)),
        f"{rng.randrange(9)}.{rng.randrange(30)}.{rng.randrange(30)}", f"at {rng.choice(words)}", f"at {rng.randrange(1, 13)}", f"@{rng.choice(words)}", f"https://{rng.choice(words)}.example.com/{n}", f"www.{rng.choice(words)}.org",
        f"{hashlib.sha256(str(n).encode()).hexdigest()[: rng.choice([24, 32, 40])]}", " ".join(str(rng.randrange(1, 999)) for _ in range(rng.randrange(2, 8))), f"the dot {rng.choice(words)}", f"look at {rng.choice(words)}. {rng.choice(words).title()}",
        f"${n}.{rng.randrange(10, 99)}", f"({rng.randrange(1, 99)})", f"{rng.randrange(1, 99)}%", f"+{rng.randrange(1, 99)}", f"{rng.randrange(99)}/{rng.randrange(1, 99)}", f"id={_number(rng, 6)}-{_number(rng, 2)}",
    ])


def examples(pieces: list[str], count: int = EXAMPLES, length: int = EXAMPLE, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(classes, tags) of ``count`` windows around spans and look-alikes set into ``pieces``; base matches of the pieces are labelled too.

    A number of 13 to 19 digits is labelled as a card whatever its check digit, as the tagger can't sum; the exact check does.
    """
    rng = random.Random(seed)
    pieces = [p for p in pieces if p.strip()] or ["word and word, the word."]
    words = sorted({w for p in pieces[:500] for w in p.split() if w.isalpha()}) or ["word"]
    x, y = np.zeros((count, length), np.uint8), np.zeros((count, length), np.int64)
    for i in range(count):
        text, spans = rng.choice(pieces), []
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            gaps = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
            at = rng.choice(gaps)
            if any(s <= at <= e for _, s, e in spans):
                continue
            kind = rng.randrange(len(KINDS)) if rng.random() < 0.65 else None
            own = look_alike(rng, words) if kind is None else made_span(rng, kind, words)
            before, after = rng.choice([(" ", ""), (" ", ""), (" (", ")"), (": ", ","), (" ", "."), ("", "")])
            put = len(before) + len(own) + len(after)
            spans = [(k, s + put * (s >= at), e + put * (s >= at)) for k, s, e in spans]
            if kind is not None:
                spans.append((kind, at + len(before), at + len(before) + len(own)))
            text = text[:at] + before + own + after + text[at:]
        for kind, s, e in base_spans(text) + [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(_digits(m.group())) <= 19]:
            if not any(s < b and a < e for _, a, b in spans):
                spans.append((kind, s, e))
        tags = np.zeros(len(text), np.int64)
        for kind, s, e in spans:
            # Spans that touch can't be told apart by tags; the later one is left out.
            if not tags[max(s - 1, 0) : e + 1].any():
                tags[s:e] = 2 * kind + 2
                tags[s] = 2 * kind + 1
        # Windows often begin or end inside a span, as those of a long text do.
        middle = rng.choice(spans)[1] if spans and rng.random() < 0.8 else rng.randrange(len(text) + 1)
        lo = max(0, min(middle - rng.randrange(length), len(text) - length)) if len(text) > length else 0
        part = classes(text[lo : lo + length])
        x[i, : len(part)], y[i, : len(part)] = part, tags[lo : lo + length]
    return x, y


def fit(docs: DataFrame, rows: int = SAMPLE) -> Tagger:
    """A tagger trained on about ``rows`` pieces of the table, drawn by a hash."""
    n = docs.count()
    pick = F.xxhash64("doc_id", "text")
    chosen = docs.where(F.pmod(pick, F.lit(1_000_003)) < min(1_000_003, int(1_000_003 * rows / max(n, 1)) + 1))
    piece = F.expr(f"substring(text, cast(pmod(xxhash64(text), greatest(length(text) - {PIECE}, 0) + 1) as int) + 1, {PIECE})")
    pieces = sorted(r[0] for r in chosen.select(piece.alias("p")).collect() if r[0])
    x, y = examples(pieces)
    return train(Tagger(len(KINDS)), x, y, STEPS, BATCH, RATE)


# Windows ------------------------------------------------------------------------


def windows(length: int, window: int = WINDOW, overlap: int = OVERLAP) -> list[int]:
    """First places of the windows over a text; the last one reaches its end."""
    return list(range(0, max(length - overlap, 1), window - overlap)) if length else []


def reconciled(found: list[tuple[int, int, int, float]], starts: list[int], length: int, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(kind, start, end) of a text's spans, from all windows' (kind, start, end, gain).

    Spans of one kind that overlap, as neighbouring windows see them, are one span over both if a window's edge cut
    either; of other spans that overlap, the choice with the largest sum of gains stays, of equals the earlier one.
    """
    edges = set(starts[1:]) | {s + window for s in starts[:-1]}
    joined: list[list] = []
    for kind in range(len(KINDS)):
        held: list[list] = []
        for k, s, e, gain in sorted(x for x in found if x[0] == kind):
            if held and s < held[-1][2] and (held[-1][1] in edges or held[-1][2] in edges or s in edges or e in edges or (s, e) == (held[-1][1], held[-1][2])):
                held[-1][2], held[-1][3] = max(held[-1][2], e), max(held[-1][3], gain)
            else:
                held.append([k, s, min(e, length), gain])
        joined += held
    joined.sort(key=lambda x: (x[2], x[1], x[0]))
    ends = [x[2] for x in joined]
    best: list[tuple[float, int, int]] = [(0.0, -1, 0)]
    for i, (_, s, _, gain) in enumerate(joined):
        free = int(np.searchsorted(ends[:i], s, "right"))
        with_it = best[free][0] + gain
        best.append((with_it, i, free) if with_it > best[i][0] else (best[i][0], -1, i))
    out, at = [], len(joined)
    while at:
        _, i, before = best[at]
        if i >= 0:
            out.append(tuple(joined[i][:3]))
        at = before
    return sorted(out)


def tagged(model: Tagger, texts: list[str], window: int = WINDOW, overlap: int = OVERLAP) -> list[list[tuple[int, int, int]]]:
    """The tagger's (kind, start, end) of each text, reconciled over its windows."""
    found = [[] for _ in texts]
    lists = [windows(len(t), window, overlap) for t in texts]
    known = [classes(t) for t in texts]
    # Windows of about one length go together, so that little is padded.
    order = sorted((min(window, len(t) - s), row, s) for row, (t, starts) in enumerate(zip(texts, lists, strict=True)) for s in starts)
    groups = -(-len(order) // TOGETHER)
    for g in range(groups):
        part = order[g * len(order) // groups : (g + 1) * len(order) // groups]
        x = np.full((len(part), part[-1][0]), PAD, np.uint8)
        for i, (size, row, s) in enumerate(part):
            x[i, :size] = known[row][s : s + size]
        for w, a, b, kind, gain in model.decode(model.emissions(x)):
            if gain >= LEAST_GAIN:
                _, row, s = part[w]
                found[row].append((kind, s + a, s + b, gain))
    return [reconciled(f, s, len(t), window) if f else [] for f, s, t in zip(found, lists, texts, strict=True)]


def added_spans(text: str, base: list[tuple[int, int, int]], tags: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The tagged spans that the exact check confirms, without gaps and stops at their ends, and that no base span overlaps."""
    out = []
    for kind, s, e in tags:
        own = text[s:e]
        s += len(own) - len(own.lstrip(" \t\r\n.,;:"))
        e = s + len(own.strip(" \t\r\n.,;:"))
        if s < e and not any(s < b and a < e for _, a, b in base) and spelled_out(kind, text[s:e]):
            out.append((kind, s, e))
    return out


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``docs`` (doc_id, text); counts are of base spans."""
    shared_dir(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = model or fit(source)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in text_slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            more = [added_spans(*x) for x in zip(texts, base, tagged(model, texts), strict=True)]
            counts = np.zeros((len(KINDS), len(texts)), np.int64)
            for i, own in enumerate(base):
                for kind, _, _ in own:
                    counts[kind, i] += 1
            shown = [hashlib.sha256(_shown(b).encode()).hexdigest() for b in base]
            every = [_shown(b + m) for b, m in zip(base, more, strict=True)]
            columns = [batch.column("doc_id"), *[pa.array(c) for c in counts], pa.array(shown), pa.array(every)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return source.mapInArrow(scan, f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")
