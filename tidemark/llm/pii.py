"""Personal data by formats, extended by bootstrapped contextual extraction.

Spans of the four base formats are seeds. Every mention of something like an identifier has lexical patterns: the
two words before it, and the word before with the word after; its own shape is no part of them. Patterns and identifiers
form a bipartite graph. A pattern counts if its words stand beside identifiers more often than not in the whole corpus.
In rounds, a pattern's confidence in a kind is the weight of its identifiers of that kind against all others, and an identifier's
is the noisy-or of its patterns; identifiers found so carry their kind and weight into the next round, so a pattern needs no
seed of its own. Patterns of high confidence then mark identifiers that no format describes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, map_arrow, pieces, texts

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
#: Identifiers that a pattern needs, and the confidence from which it counts and from which it marks.
SUPPORT, USABLE, TRUSTED = 3, 0.5, 0.8
#: Share of a pattern's places in the corpus that must hold an identifier, and the weight of an unknown one against known ones.
SPECIFIC, DOUBT = 0.5, 0.25
#: Patterns whose places are counted against a broadcast set; more are joined.
MOST_BROADCAST = 100_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# The look-behind changes nothing but the cost: a match inside a run of digits would have begun at its start.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: An identifier holds a digit, an at sign in some spelling, or an underscore; it ends at white space, quotes and brackets.
_SIGN = re.compile(r"[0-9@_]|[(\[]at[)\]]")
_END = frozenset(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\"'<>{},;|")
_REST = re.compile(r"[^\s\"'<>{},;|]*")
_NUMERIC = re.compile(r"[0-9()+./-]+")
_DIGITS = re.compile("[0-9]+")
_WORD, _REST_OF_WORD = re.compile(r"\S+"), re.compile(r"\S*")


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base formats, by kind and start; code points, end exclusive."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and _LOCAL.match(text[begin - 1]):
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            found.append((0, begin, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(x) < 20 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def _words(text: str) -> list[str]:
    return _DIGITS.sub("0", text.lower()).split()


def _words_before(text: str, at: int) -> list[str]:
    """The two words before the one that holds place `at`, fewer at the text's start."""
    reach = 64
    while True:
        part = text[max(0, at - reach) : at]
        found = part.split()
        own = bool(part) and not part[-1].isspace()
        if len(found) - own > 2 or reach >= at:
            return _words(" ".join(found[: len(found) - own][-2:]))
        reach *= 4


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans like identifiers: tokens with a sign of one, numbers of several groups with one space between them whole."""
    done = 0
    last = None
    for m in _SIGN.finditer(text):
        if m.start() < done:
            continue
        s = m.start()
        while s > done and text[s - 1] not in _END and not text[s - 1].isspace():
            s -= 1
        done = e = _REST.match(text, m.start()).end()
        if last and s == last[1] + 1 and text[last[1]] == " " and _NUMERIC.fullmatch(text, *last) and _NUMERIC.fullmatch(text, s, e):
            last = (last[0], e)
            continue
        if last:
            yield last
        last = (s, e)
    if last:
        yield last


def _trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    """The span without signs around it; a bracket stays if its other half is inside."""
    value = text[s:e].rstrip(".:!?#$%&*=-+/")
    e = s + len(value)
    value = value.lstrip(".:!?#$%&*=-/")
    s = e - len(value)
    if value.startswith(("(", "[")) and not (")" in value or "]" in value):
        s += 1
    if value.endswith((")", "]")) and not ("(" in value or "[" in value):
        e -= 1
    return s, e


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Base spans and other identifiers outside them, with their patterns."""
    spans = [(s, e, k) for k, s, e in base]
    taken = sorted((s, e) for s, e, _ in spans)
    i = 0
    for s, e in _candidates(text):
        s, e = _trimmed(text, s, e)
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s < e and _SIGN.search(text, s, e) and not (i < len(taken) and taken[i][0] < e):
            spans.append((s, e, None))
    out = []
    for s, e, kind in spans:
        before = _words_before(text, s)
        patterns = [f"{before[0]} {before[1]} _"] if len(before) == 2 else []
        after = _WORD.search(text, _REST_OF_WORD.match(text, e).end())
        if before and after and not any(c.isspace() for c in text[s:e]):
            patterns.append(f"{before[-1]} _ {_DIGITS.sub('0', after[0].lower())}")
        if patterns:
            out.append({"start": s, "end": e, "kind": kind, "value": text[s:e].lower(), "patterns": patterns})
    return out


_MENTION = "array<struct<start: int, end: int, kind: int, value: string, patterns: array<string>>>"


def _extracted(docs: DataFrame, kind: str) -> DataFrame:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        base, near = [], []
        for text in batch.column("text").to_pylist():
            signs = _SIGN.search(text)
            own = base_spans(text) if signs else []
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
            near.append(mentions(text, own) if signs else [])
        return [batch.column("doc_id"), batch.column("text_hash"), pa.array(base, pa.list_(span)), pa.array(near, pa.list_(mention))]

    return map_arrow(docs, run, f"doc_id {kind}, text_hash bigint, base array<struct<kind: int, start: int, end: int>>, mentions {_MENTION}")


def pattern_places(docs: DataFrame, patterns: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """pattern and places: how often the words of each of `patterns` stand around any word in the texts of `docs`."""
    few = patterns.count() <= most_broadcast
    wanted = {r.pattern for r in patterns.collect()} if few else None
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = shared.value
        firsts = None if only is None else {x.split(" ")[0] for x in only}
        count: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["pattern", "places"])
            count.clear()
            return out

        for batch in pieces(batches):
            for text in batch.column("text").to_pylist():
                words = _words(text)
                for i in range(len(words) - 2) if firsts is None else [i for i, w in enumerate(words[:-2]) if w in firsts]:
                    for x in (f"{words[i]} {words[i + 1]} _", f"{words[i]} _ {words[i + 2]}"):
                        if only is None or x in only:
                            count[x] += 1
            if len(count) > 200_000:
                yield flush()
        yield flush()

    counted = docs.select("text").mapInArrow(run, "pattern string, places bigint").groupBy("pattern").agg(F.sum("places").alias("places"))
    return counted if few else counted.join(patterns, "pattern", "left_semi")


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, confidence and kind of the usable patterns. edges: distinct pattern, value and kind (null: no seed)."""
    edges = edges.select("pattern", "value", F.col("kind").isNotNull().alias("seed"), "kind", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0).alias("conf"))
    scored = None
    for r in range(rounds):
        weights = [F.sum(F.when(F.col("kind") == k, F.col("conf")).otherwise(0.0)).alias(f"k{k}") for k in range(len(KINDS))]
        by_pattern = edges.groupBy("pattern").agg(*weights, F.sum(1 - F.col("conf")).alias("unknown"), F.count_if(F.col("conf") >= USABLE).alias("support"))
        most = F.greatest(*[f"k{k}" for k in range(len(KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"k{k}") == most, F.lit(k)) for k in range(len(KINDS))])
        known = sum((F.col(f"k{k}") for k in range(len(KINDS))), F.lit(0.0))
        usable = by_pattern.where(F.col("support") >= SUPPORT).select("pattern", (most / (known + F.col("unknown") * DOUBT + 1)).alias("confidence"), kind.alias("of_kind")).where(F.col("confidence") >= USABLE)
        scored = checkpointed(usable)
        if r + 1 < rounds:
            doubt = F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))))
            values = edges.join(scored, "pattern").groupBy("value").agg((1 - doubt).alias("found"), F.max_by("of_kind", F.struct("confidence", "of_kind")).alias("found_kind"))
            found = edges.join(values, "value", "left")
            edges = checkpointed(found.select("pattern", "value", "seed", F.when(F.col("seed"), F.col("kind")).otherwise(F.col("found_kind")).alias("kind"), F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))).alias("conf")))
    return scored.select("pattern", "confidence", F.col("of_kind").alias("kind"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of a sorted array of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end), by kind and start; spans has what patterns add.

    A row for each row of `docs`; null and empty texts have no spans. kind is the place in KINDS. Added
    spans never overlap base ones. Copies of a document count once for a pattern's confidence, since that weighs different
    values; of patterns that tie for a mention the last kind counts. Repeated rows each come out."""
    kind = docs.schema[id_col].dataType.simpleString()
    plain = texts(docs, id_col=id_col, text_col=text_col)
    rows = checkpointed(_extracted(plain.withColumn("text_hash", F.xxhash64("text")), kind))
    near = rows.where(F.size("mentions") > 0).select("doc_id", "text_hash", F.explode("mentions").alias("m"))
    edges = near.select(F.explode("m.patterns").alias("pattern"), F.col("m.value").alias("value"), F.col("m.kind").alias("kind"))
    edges = checkpointed(edges.groupBy("pattern", "value").agg(F.min("kind").alias("kind"), F.count("*").alias("n")))
    able = checkpointed(edges.groupBy("pattern").agg(F.count("*").alias("values"), F.sum("n").alias("n")).where(F.col("values") >= SUPPORT).select("pattern", "n"))
    places = pattern_places(plain, able.select("pattern"), most_broadcast)
    specific = checkpointed(able.join(places, "pattern", "left").where(F.coalesce("places", F.lit(0)) * SPECIFIC <= F.col("n")).select("pattern"))
    scored = score_patterns(edges.join(specific, "pattern", "left_semi")).where(F.col("confidence") >= TRUSTED)
    fresh = near.where("m.kind is null").select("doc_id", "text_hash", F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.explode("m.patterns").alias("pattern"))
    fresh = fresh.join(scored, "pattern").groupBy("doc_id", "text_hash", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    added = fresh.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    same = F.col("r.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("r.text_hash") == F.col("a.text_hash"))
    joined = rows.alias("r").join(added.alias("a"), same, "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return joined.select(F.col("r.doc_id").alias("doc_id"), "base", spans.alias("spans"))


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base counts by kind, base_sha256 and spans as text."""
    found = find_pii(docs, id_col, text_col)
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
