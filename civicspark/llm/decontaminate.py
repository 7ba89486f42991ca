"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts are cut into words.  Numbers become ``<num>``, a unit behind a number
``<unit>``, a capitalised word inside a sentence ``<name>``; everything else is
lower-cased.  Windows of ``window`` canonical words are templates; equal hashes
of a document's and a benchmark item's template are a match, so a question that
comes back with other numbers, names or units is found like an exact copy.

Matches are grouped by alignment (document, item, distance of the two
positions).  An alignment counts if it has enough matched templates and its
slots are consistent: each number, name or unit of the item must always stand
for the same value in the document.  Templates that are mostly placeholders say
nothing; such windows are indexed by their literal lower-cased words instead, so
that an exact copy of any item is found.  An alignment has enough matches if it
has LEAST_MATCHES templates, or all that the item has if fewer, or as many
windows of both kinds.

A document's words are cut into pieces, and each window becomes a row with its
own words, so what a task holds of a text beyond its list of words follows the
piece.  Only the benchmark's template index is broadcast, after adding up its
bytes; a larger benchmark is joined by shuffling both sides on the hash.  Items of equal text are one
item, reported under the smallest id.

An item shorter than a window is one template of all its words, looked up among
document windows of that length.  What precedes an item's first word in a document
may change its canonical form, so the first window is indexed in every form.

Defined cases: texts that are null or without words match nothing; a very short
item (one word, one number) is in every document that has it; rows that repeat a
document or a passage count once per alignment; an empty benchmark flags nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
LEAST_MATCHES = 3            # templates an alignment needs (all, if the item has fewer)
PIECE_WORDS = 1_024          # words of a text that are held together
LEAST_LITERAL = 5            # words of a template that are no placeholder; windows with fewer are compared literally
INDEX_BYTES = 50_000_000     # a template index up to this size is broadcast
SENTENCE = "."               # marks a sentence end until names are told apart
SLOTS = ["<num>", "<name>", "<unit>"]
# fixed values: units that may follow a number
UNITS = """mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons
tonne tonnes oz lb lbs pound pounds ml l liter liters litre litres s sec second seconds min minute minutes h hr
hour hours day days week weeks month months year years percent usd eur gbp dollar dollars euro euros cent cents
c f k hz khz mhz w kw mw v a j kj n pa kpa b kb mb gb tb""".split()


def marked(text: Column) -> Column:
    """The words of ``text``, a space between two; one behind which a sentence ends has SENTENCE at its end.
    Without the words there may be one entry in front and one at the end (empty, or SENTENCE in front)."""
    joined = F.regexp_replace(text, r"(\d)[.,](?=\d)", "$1")
    spaced = F.regexp_replace(joined, r"[^\p{L}\p{N}.!?\n\r|]+", " ")
    return F.regexp_replace(spaced, r" ?[.!?\n\r|][^\p{L}\p{N}]*", f"{SENTENCE} ")


def word_lists(text: Column) -> tuple[Column, Column]:
    """Of ``marked`` text: the words with their marks, and in lower case without."""
    return F.split(text, " "), F.split(F.replace(F.lower(text), F.lit(SENTENCE), F.lit("")), " ")


def canonical(cut: Column, low: Column, made: Callable[[Column, Column], Column]) -> Column:
    """``made`` of the canonical form and the lower-case form of each word."""
    number = lambda w: (w >= "0") & (w < ":")  # noqa: E731 - by its first character
    unit = F.array(*[F.lit(u) for u in UNITS])

    def one(w: Column, i: Column) -> Column:
        before, v = F.get(cut, i - 1), F.get(low, i)
        inside = before.isNotNull() & ~before.endswith(SENTENCE)
        return made(F.when(number(w), "<num>")
                    .when((v != w) & inside & w.rlike(r"^\p{Lu}\p{Ll}") & (v != F.rtrim(w, F.lit(SENTENCE))), "<name>")
                    .when(number(before) & inside & F.array_contains(unit, v), "<unit>")
                    .otherwise(v), v)
    return F.transform(cut, one)


def is_slot(word: Column) -> Column:
    return word["t"].startswith("<")


def literal_hash(word: Callable[[int], Column], window: int) -> Column:
    return F.xxhash64(F.lit("literal"), *[word(k) for k in range(window)])


def canonical_words(text: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the canonical words ``w`` (``t``, and ``v``, the word itself), their forms ``t`` and 1 for each
    placeholder (``slot``)."""
    # no filter on what is computed here: pushed down, it would compute the words anew for each word
    cut = _cut(text, keep)
    w = cut.select(*keep, canonical(F.col("cut"), F.col("low"), lambda t, v: F.struct(t.alias("t"), v.alias("v"))).alias("w"))
    w = w.select(*keep, F.filter("w", lambda s: s["v"] != "").alias("w"))
    # transform, as "w.t" would be pulled into the lambda and be built for each window
    return w.select(*keep, "w", F.transform("w", lambda s: s["t"]).alias("t"),
                    F.transform("w", lambda s: F.when(is_slot(s), 1).otherwise(0)).alias("slot"))


def _cut(text: DataFrame, keep: list[str]) -> DataFrame:
    cut, low = word_lists(F.col("marked"))
    return text.select(*keep, marked(F.col("text")).alias("marked")).select(*keep, cut.alias("cut"), low.alias("low"))


def templates(text: DataFrame, keep: list[str], sizes: list[int], literal: bool) -> DataFrame:
    """``keep`` and a row for each window of each of the ``sizes``: its place (``doc_at``), its ``hash`` and its
    ``words``; if ``literal``, windows of mostly placeholders have the hash of their literal words.

    A text's words go on in pieces of PIECE_WORDS, each with the word before it and the rest of its last
    windows, and a window is a row that points into its piece: what is held follows the piece, not the text.
    The empty entries at the ends of a text are in no item, so windows with them match nothing."""
    most = max(sizes)
    last = F.size("cut") - 1
    # explode_outer: explode() would test the list, and make the words anew for that
    at = _cut(text, keep).select(*keep, "cut", "low", F.explode_outer(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS))).alias("start"))
    first = F.greatest(F.col("start") - 1, F.lit(0))
    length = F.col("start") - first + PIECE_WORDS + most - 1
    piece = at.select(*keep, first.alias("first_word"), (F.col("start") - first).alias("before"),
                      F.slice("cut", first + 1, length).alias("cut"), F.slice("low", first + 1, length).alias("low"))
    piece = piece.select(*keep, "first_word", "before", "low",
                         canonical(F.col("cut"), F.col("low"), lambda t, v: F.xxhash64(t)).alias("t"))
    end = F.least(F.size("t"), F.col("before") + PIECE_WORDS) - 1
    starts = F.when(end >= F.col("before"), F.sequence(F.col("before"), end))
    one = piece.select(*keep, "first_word", "low", "t", F.explode_outer(starts).alias("i"))
    if len(sizes) > 1:
        one = one.select("*", F.explode_outer(F.array(*[F.lit(n) for n in sizes])).alias("size"))
    else:
        one = one.withColumn("size", F.lit(most))
    one = one.filter(F.col("i") + F.col("size") <= F.size("t"))

    def of(entries: str, k: int) -> Column:
        entry = F.get(entries, F.col("i") + k)
        return entry if k < min(sizes) else F.when(F.col("size") > k, entry)       # null changes no hash
    out = F.xxhash64(*[of("t", k) for k in range(most)])
    if literal:
        slots = [F.xxhash64(F.lit(t)) for t in SLOTS]
        slot_words = sum((F.when(of("t", k).isin(*slots), 1).otherwise(0) for k in range(1, most)),
                         F.when(of("t", 0).isin(*slots), 1).otherwise(0))
        out = (F.when(slot_words > F.col("size") - F.least("size", F.lit(LEAST_LITERAL)), literal_hash(lambda k: of("low", k), most))
               .otherwise(out))
    return one.select(*keep, (F.col("first_word") + F.col("i")).alias("doc_at"), out.alias("hash"),
                      F.array(*[F.get("low", F.col("i") + k) for k in range(most)]).alias("words"))


def template_index(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per window of an item and form of its first word: hash, ``size`` in words, whether it is a
    ``template``, its ``slots`` (offset and value), the ``first`` word if the document must have it, and how many windows (``least``) or templates (``least_templates``, null if it has none) a match needs."""
    items = (benchmark.filter(F.col("text").isNotNull()).groupBy("text")
             .agg(F.min("item_id").alias("item_id")))
    w = canonical_words(items, ["item_id"])
    size = F.least(F.size("w"), F.lit(window))
    last = F.size("w") - size

    def is_template(start: Column, first_slot: Column) -> Column:
        literal = F.size(F.filter(F.slice("w", start + 2, window - 1), lambda s: ~is_slot(s)))
        return literal + F.when(first_slot, 0).otherwise(1) >= F.least(size, F.lit(LEAST_LITERAL))

    def slot_at(start: Column) -> Column:
        return F.get("slot", start) == 1
    # templates in every form; if there are none, those in the item's own form
    sure = F.size(F.filter(F.sequence(F.lit(0), last), lambda i: is_template(i, slot_at(i) | (i == 0))))
    n = F.greatest(sure, F.when(is_template(F.lit(0), slot_at(F.lit(0))), 1).otherwise(0))
    at = (w.filter(F.size("w") > 0)
          .select("item_id", "w", "t", "slot", size.alias("size"), F.least(last + 1, F.lit(LEAST_MATCHES)).alias("least"),
                  F.when(n > 0, F.least(n, F.lit(LEAST_MATCHES))).alias("least_templates"),
                  F.explode(F.sequence(F.lit(0), last)).alias("item_at")))
    word, own = F.get("w", F.col("item_at"))["v"], F.get("t", F.col("item_at"))
    forms = (F.when((F.col("item_at") > 0) | (own == "<num>"), F.array(own))
             .when(F.array_contains(F.array(*[F.lit(u) for u in UNITS]), word), F.array(word, F.lit("<name>"), F.lit("<unit>")))
             .otherwise(F.array(word, F.lit("<name>"))))
    at = at.withColumn("form", F.explode(forms))
    at = at.withColumn("template", is_template(F.col("item_at"), F.col("form").startswith("<")))
    rest = [F.get("t", F.col("item_at") + k) for k in range(1, window)]
    rest = [F.when(t.isNotNull(), F.xxhash64(t)) for t in rest]                 # null past the end changes no hash
    hashed = (F.when(F.col("template"), F.xxhash64(F.xxhash64("form"), *rest))
              .otherwise(literal_hash(lambda k: F.get("w", F.col("item_at") + k)["v"], window)))
    # a first word that is a placeholder in this form only must be the item's word
    first = F.when(F.col("form").startswith("<") & (F.col("form") != own), word)
    inside = F.transform(F.slice("w", F.col("item_at") + 1, window),
                         lambda s, k: F.struct(k.alias("k"), s["t"].alias("t"), s["v"].alias("v")))
    slots = F.filter(inside, lambda s: F.col("template") & is_slot(s))       # literal words need no comparison
    return at.select(hashed.alias("hash"), "item_id", "item_at", "size", "template", first.alias("first"), "least",
                     "least_templates", slots.alias("slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, keys: list[str] | None = None,
                 window: int = WINDOW) -> DataFrame:
    """One row per document (``keys``, default doc_id) and item it contains: ``matches`` of the best
    alignment and whether its slot values are ``exact``ly the item's."""
    keys = keys or ["doc_id"]
    index = template_index(benchmark, window)
    slot_bytes = F.aggregate("slots", F.lit(0), lambda n, s: n + F.length(s["t"]) + F.length(s["v"]) + 40)
    size, literal, sizes = index.agg(F.sum(slot_bytes + 120), F.max(~F.col("template")), F.collect_set("size")).first()
    index = index.drop("size")
    small = (size or 0) <= INDEX_BYTES
    at = templates(docs.select(*keys, "text"), keys, sorted({window, *sizes}, reverse=True), bool(literal))
    if small:
        index = F.broadcast(index)
    word = lambda k: F.get("words", k)
    same_first = F.col("first").isNull() | (F.col("first") == word(F.lit(0)))
    hit = at.join(index, "hash").filter(same_first).select(
        *keys, "item_id", "item_at", "template", "least", "least_templates",
        (F.col("doc_at") - F.col("item_at")).alias("shift"),
        F.transform("slots", lambda s: F.struct(s["v"].alias("item"), word(s["k"]).alias("doc"))).alias("pairs"))
    side = [*keys, "item_id", "shift"]
    counted = hit.groupBy(*side).agg(
        F.count_distinct("item_at").alias("matches"), F.first("least").alias("least"),
        F.size(F.collect_set(F.when(F.col("template"), F.col("item_at")))).alias("of_templates"),
        F.first("least_templates").alias("least_templates"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))     # at most one item's slots
    values = F.array_distinct(F.transform("pairs", lambda p: p["item"]))
    enough = (F.col("matches") >= F.col("least")) | (F.col("of_templates") >= F.col("least_templates"))
    counted = counted.filter(enough & (F.size("pairs") == F.size(values)))
    same = F.forall("pairs", lambda p: p["item"].eqNullSafe(p["doc"]))
    return counted.groupBy(*keys, "item_id").agg(F.max("matches").alias("matches"), F.max(same).alias("exact"))
