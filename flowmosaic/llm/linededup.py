"""Near-equal lines: a segment-partition edit join, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import connected_components, materialize

EDITS = 2
#: Shorter lines are copies only if they are equal: at a few characters any two are near.
MIN_CHARS = 24
#: A line's place in one decimal: doc_id * LINES + 31 bits of the text's hash * LINE + line number.
LINE = 1 << 31
LINES = LINE * LINE
#: Places of rows without an id lie from here on and hold 64 bits of hash.
NO_ID = 1 << 125
#: A common line makes up at least 1 / COMMON of all; its rows are dealt to ``SALTS`` tasks.
COMMON = 1 << 15
SALTS = 64
#: Words of the bitmap that picks candidate lines.
BITMAP = 1 << 17
#: Letters whose counts tell most different lines apart before their distance is computed.
LETTERS = "etaoinsr"


def lines_of(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(_key, _row, line_no, line) of every line of ``min_chars`` or more; ``_row`` is the hash of the whole text."""
    split = docs.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(F.col(f"`{text}`")).alias("_row"), F.split(F.col(f"`{text}`"), "\n").alias("_lines"))
    return split.select("_key", "_row", F.posexplode("_lines").alias("line_no", "line")).filter(F.length("line") >= min_chars)


def exact(value: int | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("decimal(38,0)")


def place(key: str, row: str, at: str) -> Column:
    """Total order of places: by id (nulls after all others), hash of the text, line number."""
    key, row, at = F.col(key), F.col(row), F.col(at).cast("bigint")
    inside = row.bitwiseAND(F.lit(LINE - 1)) * F.lit(LINE) + at
    unnamed = exact(NO_ID) + exact((exact(row) + exact(1 << 63)) * exact(LINE)) + exact(at)
    return F.when(key.isNull(), exact(unnamed)).otherwise(exact(exact(exact(key) * exact(LINES)) + exact(inside)))


def id_and_line(at: Column) -> tuple[Column, Column]:
    """Id (null if there is none) and line number of a place."""
    whole = F.call_function("div", at - F.pmod(at, exact(LINES)), exact(LINES))
    return F.when(at < exact(NO_ID), whole).cast("bigint"), F.pmod(at, exact(LINE)).cast("int")


def line_hashes(line: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes; equal lines have equal pairs."""
    return F.xxhash64(line), F.xxhash64(F.lit(1), line)


def line_name(first: Column, second: Column) -> Column:
    """126 bits of both hashes of a line in one number."""
    return exact(exact(exact(first) * exact(1 << 62)) + exact(second.bitwiseAND(F.lit((1 << 62) - 1))))


def segment_start(length: Column, part: int, parts: int) -> Column:
    """0-based start of an even segment; ``part`` = ``parts`` gives the end."""
    return F.floor(length * part / parts).cast("int")


def index_keys(line: Column, length: Column, edits: int) -> Column:
    """One key per segment: length of the line, number of the segment, its characters."""
    parts = edits + 1
    keys = []
    for part in range(parts):
        start = segment_start(length, part, parts)
        keys.append(F.xxhash64(length, F.lit(part), F.substring(line, start + 1, segment_start(length, part + 1, parts) - start)))
    return F.array(*keys)


def probe_keys(line: Column, length: Column, edits: int) -> Column:
    """The keys under which a line of equal or smaller length within ``edits`` is indexed.

    For a line ``shorter`` characters shorter, a segment that has stayed whole lies at most ``part``
    places from its start (edits before it) and, counted from the end, at most ``edits - part``.
    Windows beyond the line give keys that meet nothing or are refuted later.
    """
    parts = edits + 1
    keys = []
    for shorter in range(edits + 1):
        other = length - shorter
        for part in range(parts):
            start = segment_start(other, part, parts)
            size = segment_start(other, part + 1, parts) - start
            for shift in range(max(-part, shorter - (edits - part)), min(part, shorter + edits - part) + 1):
                keys.append(F.xxhash64(other, F.lit(part), F.substring(line, start + shift + 1, size)))
    return F.array(*keys)


def shiftleft(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by)


def pair_parity(line: Column) -> Column:
    """64 parity bits of the pairs of neighbouring words.

    One edit takes three pairs at most and brings two (or the other way round), so it flips five bits at most.
    """
    one = F.lit(1).cast("bigint")
    start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("bigint").alias("bits"))

    def add(state: Column, word: Column) -> Column:
        flip = shiftleft(one, F.hash(state["last"], word).bitwiseAND(F.lit(63)))
        return F.struct(F.hash(word).alias("last"), state["bits"].bitwiseXOR(flip).alias("bits"))

    ends = F.concat(F.split(line, " "), F.array(F.lit("")))
    return F.aggregate(ends, start, add)["bits"]


def edits_within(left: Column, right: Column, edits: int) -> Column:
    """Edit distance of two strings if it is ``edits`` or less, else a larger number.

    Bit-parallel over a diagonal band: bit b of a vector stands for row j - edits + b of column j, and
    one pass of a few word operations moves the band on by one character. Lengths differ by
    ``edits`` at most.
    """
    width = 2 * edits + 1
    ones = (1 << width) - 1
    long = lambda n: F.lit(n).cast("bigint")
    pad = F.array_repeat(F.lit(""), edits)
    # the characters ride in the state: what a lambda takes from outside is evaluated at every step
    start = F.struct(
        long(ones ^ ((1 << edits) - 1)).alias("vp"), long(0).alias("vn"), F.least(F.length(left), F.lit(edits)).cast("bigint").alias("score"),
        F.length(left).alias("n"), F.concat(pad, F.split(left, ""), pad, pad).alias("rows"), F.split(right, "").alias("columns"),
    )

    def step(state: Column, at: Column) -> Column:
        char, rows, n_rows = F.get(state["columns"], at), state["rows"], state["n"]
        match = long(0)
        for bit in range(width):
            same = F.get(rows, at + bit) == char
            match = match.bitwiseOR(F.when(same, long(1 << bit)).otherwise(long(0)))
        vp, vn = state["vp"], state["vn"]
        d0 = ((match.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(match).bitwiseOR(vn).bitwiseAND(long(ones))
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(long(ones)))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        # along the band's lowest diagonal until it meets the last row, then along that row
        bit = n_rows - 1 - at + edits
        mask = F.call_function("shiftleft", long(1), F.greatest(F.lit(0), F.least(F.lit(width), bit)))
        sets = lambda v, m: (v.bitwiseAND(m) != 0).cast("bigint")
        score = state["score"] + F.when(
            bit >= width - 1, 1 - sets(d0, long(1 << (width - 1)))
        ).otherwise(sets(hp, mask) - sets(hn, mask))
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(long(ones))).alias("vp"),
            down.bitwiseAND(hp).alias("vn"), score.alias("score"),
            n_rows.alias("n"), rows.alias("rows"), state["columns"].alias("columns"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.length(right) - 1), start, step)["score"]


def character_parity(line: Column) -> Column:
    """128 parity bits (``low``, ``high``) of the pairs of neighbouring characters; one edit flips four at most."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    start = F.struct(F.lit("").alias("last"), none.alias("low"), none.alias("high"))

    def add(state: Column, char: Column) -> Column:
        at = F.hash(state["last"], char).bitwiseAND(F.lit(127))
        flip = shiftleft(one, at.bitwiseAND(F.lit(63)))
        return F.struct(
            char.alias("last"),
            state["low"].bitwiseXOR(F.when(at < 64, flip).otherwise(none)).alias("low"),
            state["high"].bitwiseXOR(F.when(at < 64, none).otherwise(flip)).alias("high"),
        )

    return F.aggregate(F.concat(F.split(line, ""), F.array(F.lit(""))), start, add).dropFields("last")


def differing(left: str, right: str) -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right)))


def index_and_probes(lines: DataFrame, edits: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the index and rows that probe it: ``key`` and the other columns of ``lines``, ending in _x and _y.

    ``equal_y`` marks probes for lines of the same length.
    """
    base = lines.withColumn("_len", F.length("line"))
    others = [c for c in lines.columns if c != "line"]
    indexed = base.select(*[F.col(c).alias(f"{c}_x") for c in others], F.explode(index_keys(F.col("line"), F.col("_len"), edits)).alias("key"))
    equal = sum(2 * min(part, edits - part) + 1 for part in range(edits + 1))
    probes = base.select(F.posexplode(probe_keys(F.col("line"), F.col("_len"), edits)).alias("_at", "key"), *[F.col(c).alias(f"{c}_y") for c in others])
    return indexed, probes.withColumn("equal_y", F.col("_at") < equal).drop("_at")


def lines_with_partners(lines: DataFrame, edits: int) -> DataFrame:
    """(name) of the lines that share a key with another line; each comes once, however many it meets."""
    named = lines.select("line", F.length("line").alias("len"), F.xxhash64("line").alias("name"))

    def keyed(keys: Callable[[Column, Column, int], Column]) -> DataFrame:
        return named.select("name", F.explode(keys(F.col("line"), F.col("len"), edits)).alias("key"))

    # no renaming in between: both joins then read the same two shuffles
    indexed, probes = keyed(index_keys).alias("i"), keyed(probe_keys).alias("p")
    meet = (F.col("i.key") == F.col("p.key")) & (F.col("i.name") != F.col("p.name"))
    asking, asked = probes.join(indexed, meet, "left_semi"), indexed.join(probes, meet, "left_semi")
    return asking.select("name").unionByName(asked.select("name")).distinct()


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """(x, y) names of lines that share a key and differ in few enough bits of all parities; no texts travel.

    lines(name, line, bits, low, high). Two lines of one name are both looked at when candidates are verified.
    """
    indexed, probes = index_and_probes(lines.select("line", "name", "bits", "low", "high"), edits)
    # lines of the same length find each other from either side: one is enough
    once = (F.col("name_x") < F.col("name_y")) | (~F.col("equal_y") & (F.col("name_x") != F.col("name_y")))
    words = differing("bits_x", "bits_y") <= 5 * edits
    characters = differing("low_x", "low_y") + differing("high_x", "high_y") <= 4 * edits
    met = probes.join(indexed, (probes["key"] == indexed["key"]) & once & words & characters)
    return met.select(F.col("name_x").alias("x"), F.col("name_y").alias("y")).distinct()


def only_named(lines: DataFrame, names: DataFrame) -> DataFrame:
    """The lines whose name may be among the names, found by a bitmap of fixed size (``BITMAP`` words of 64 bits).

    The bitmap is broadcast and never larger; the more names there are, the more other lines pass.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP * 64))
    words = names.select(F.floor(bit("name") / 64).cast("int").alias("_word"), shiftleft(F.lit(1).cast("bigint"), (bit("name") % 64).cast("int")).alias("_bit"))
    bitmap = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    asked = lines.withColumn("name", F.xxhash64("line")).withColumn("_word", F.floor(bit("name") / 64).cast("int"))
    here = shiftleft(F.lit(1).cast("bigint"), (bit("name") % 64).cast("int"))
    return asked.join(F.broadcast(bitmap), "_word").filter(F.col("_bits").bitwiseAND(here) != 0).drop("_word", "_bits")


def letters_apart(left: Column, right: Column) -> Column:
    """How much the counts of frequent letters differ; one edit changes the sum by two at most."""
    def count(line: Column, letter: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(letter)))

    return sum((F.abs(count(left, c) - count(right, c)) for c in LETTERS), start=F.lit(0))


def shared_start(left: Column, right: Column) -> Column:
    """Length of the common beginning, by bisection (up to 2^31 characters)."""
    most = F.least(F.length(left), F.length(right))
    start = F.struct(F.lit(0).alias("low"), most.alias("high"), left.alias("l"), right.alias("r"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        same = F.substring(state["l"], F.lit(1), middle) == F.substring(state["r"], F.lit(1), middle)
        return F.struct(
            F.when(same, middle).otherwise(state["low"]).alias("low"),
            F.when(same, state["high"]).otherwise(middle - 1).alias("high"), state["l"].alias("l"), state["r"].alias("r"),
        )

    turns = F.sequence(F.lit(0), F.ceil(F.log2(most + 2)).cast("int"))
    return F.aggregate(turns, start, halve)["low"]


def trimmed(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Both strings without their common beginning and end, which no best edit touches."""
    cut = pairs.withColumn("_p", shared_start(F.col(left), F.col(right)))
    cut = cut.withColumn(left, F.substring(left, F.col("_p") + 1, F.length(left))).withColumn(right, F.substring(right, F.col("_p") + 1, F.length(right)))
    cut = cut.withColumn("_p", shared_start(F.reverse(left), F.reverse(right)))
    end = lambda c: F.substring(c, F.lit(1), F.length(c) - F.col("_p"))
    return cut.withColumn(left, end(left)).withColumn(right, end(right)).drop("_p")


def near_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Links between different lines at ``edits`` or less, each once: (a, b), their first places, a <= b, and both hashes
    of either line, (a_h, a_i) and (b_h, b_i).

    lines(_key, _row, line_no, line), repeats included. A first pass finds which lines share a segment with another
    at all, one row each; only they get a signature and meet in pairs. Texts travel for the pairs left then.
    """
    names = materialize(lines_with_partners(lines.select("line").distinct(), edits), "names")
    firsts = only_named(lines, names).groupBy("name", "line").agg(F.min(place("_key", "_row", "line_no")).alias("first"))
    asked = materialize(
        firsts.withColumn("bits", pair_parity(F.col("line"))).withColumn("_c", character_parity(F.col("line"))).select("*", "_c.*").drop("_c"), "asked"
    )
    pairs = materialize(candidate_pairs(asked, edits), "pairs")
    first, second = line_hashes(F.col("line"))
    end = F.struct(F.col("first").alias("place"), first.alias("h"), second.alias("i"))
    left = asked.select(F.col("name").alias("x"), end.alias("_a"), F.col("line").alias("_left"))
    right = asked.select(F.col("name").alias("y"), end.alias("_b"), F.col("line").alias("_right"))
    both = pairs.join(left, "x").join(right, "y").filter(
        (F.abs(F.length("_left") - F.length("_right")) <= edits) & (letters_apart(F.col("_left"), F.col("_right")) <= 2 * edits)
    )
    both = materialize(trimmed(both, "_left", "_right").select("_a", "_b", "_left", "_right"), "middles")
    one_empty = (F.length("_left") == 0) | (F.length("_right") == 0)
    distance = F.when(one_empty, F.greatest(F.length("_left"), F.length("_right")))
    if edits <= 2:  # both ends of a middle differ, so two edits are spent there and what lies between stands in the other
        distance = distance.when(~F.contains("_right", F.expr("substring(_left, 2, length(_left) - 2)")), edits + 1)
    distance = distance.otherwise(edits_within(F.col("_left"), F.col("_right"), edits))
    linked = both.filter(distance <= edits).select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()
    return linked.select(
        F.col("_a.place").alias("a"), F.col("_b.place").alias("b"),
        F.col("_a.h").alias("a_h"), F.col("_a.i").alias("a_i"), F.col("_b.h").alias("b_h"), F.col("_b.i").alias("b_i"),
    )


def linked_lines(links: DataFrame) -> DataFrame:
    """(_h, _i, _class, n_links) of every linked line: first place of its class, and the lines linked to it directly.

    Lines are known by their hashes: rows that share an id may have different lines at equal places.
    """
    classes = connected_components(links.select(line_name(F.col("a_h"), F.col("a_i")).alias("a"), line_name(F.col("b_h"), F.col("b_i")).alias("b")))
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("first"), F.col(f"{c}_h").alias("_h"), F.col(f"{c}_i").alias("_i")) for c in "ab"]))
    lines = links.select(ends.alias("_end")).select("_end.*").groupBy("_h", "_i").agg(F.min("first").alias("first"), F.count("*").alias("n_links"))
    placed = lines.withColumn("node", line_name(F.col("_h"), F.col("_i"))).join(classes, "node")
    least = placed.groupBy("component").agg(F.min("first").alias("_class"))
    return placed.join(least, "component").select("_h", "_i", "_class", "n_links")


def classed_lines(docs: DataFrame, key: str, text: str, edits: int, min_chars: int) -> DataFrame:
    """(_key, _row, line_no, _class, n_copies, n_links, kept) of every line that has a word or ``min_chars`` characters."""
    lines = lines_of(docs, key, text, 1).filter((F.length("line") >= min_chars) | F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
    links = materialize(near_lines(lines_of(docs, key, text, min_chars), edits), "linked")
    first, second = line_hashes(F.col("line"))
    marked = lines.select("_key", "_row", "line_no", first.alias("_h"), second.alias("_i"))
    counted = marked.groupBy("_h", "_i").agg(F.min(place("_key", "_row", "line_no")).alias("first"), F.count("*").alias("n_copies"))
    body = F.col(f"`{text}`")
    ends = docs.agg(F.sum(F.length(body) - F.length(F.replace(body, F.lit("\n"))) + 1)).first()[0] or 0
    # no more than COMMON lines can be so common; each of them is dealt to SALTS tasks
    common = F.col("n_copies") >= max(2, -(-ends // COMMON))
    salts = F.when(common, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    named = counted.join(linked_lines(links), ["_h", "_i"], "left").select(
        "_h", "_i", F.coalesce("_class", "first").alias("_class"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.explode(salts).alias("_salt")
    )
    hot = counted.filter(common).select("_h", "_i", F.col("first").isNotNull().alias("_hot"))
    dealt = marked.join(F.broadcast(hot), ["_h", "_i"], "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("_key", "_row", "line_no"), F.lit(SALTS)).cast("int")).otherwise(0)
    )
    return dealt.join(named, ["_h", "_i", "_salt"]).select(
        "_key", "_row", "line_no", "_class", "n_copies", "n_links", (place("_key", "_row", "line_no") == F.col("_class")).alias("kept")
    )


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that has a word or ``min_chars`` characters, in every document.

    (key, line_no, class_doc_id, class_line_no, n_copies, n_links, kept): the class is named by the first
    place among all lines reachable over links of ``edits`` or less. Places are in the order of key, hash of the
    text, line number from 0; a null key counts as largest and names its class null.
    Lines under ``min_chars`` are in a class with equal lines only;
    ``n_copies`` counts the line itself wherever it stands, ``n_links`` the different lines linked
    directly; ``kept`` marks the first place. Null texts have no lines. Keys are whole numbers.
    Rows that share a key, or have none, are told apart by their texts; rows equal in key and text tie: their lines
    are at the same places and stay together.
    """
    at_id, at_line = id_and_line(F.col("_class"))
    return classed_lines(docs, key, text, edits, min_chars).select(
        F.col("_key").alias(key), "line_no", at_id.alias("class_doc_id"), at_line.alias("class_line_no"), "n_copies", "n_links", "kept"
    )


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns, with every line removed that is not the first of its class.

    Lines without a word and under ``min_chars`` stay. A document that loses all its lines stays with an empty text; null texts stay
    null. Rows with a repeated or null key lose their own lines only; of rows equal in key and text each keeps the first lines.
    """
    taken = {c.lower() for c in docs.columns}
    names = [next(n for n in (f"_{word}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken) for word in ("key", "row", "gone")]
    key_name, row_name, gone_name = names
    gone = (
        classed_lines(docs, key, text, edits, min_chars).filter(~F.col("kept"))
        .groupBy(F.col("_key").alias(key_name), F.col("_row").alias(row_name)).agg(F.sort_array(F.collect_set("line_no")).alias(gone_name))
    )
    body, numbers = F.col(f"`{text}`"), F.col(gone_name)
    # true at every dropped line, false in the gaps between them; what comes after the last one has no mark
    gap = lambda number, at: number - F.when(at == 0, F.lit(-1)).otherwise(F.get(numbers, at - 1)) - 1
    marks = F.flatten(F.transform(numbers, lambda number, at: F.concat(F.array_repeat(F.lit(False), gap(number, at)), F.array(F.lit(True)))))
    left = F.filter(F.zip_with(F.split(body, "\n"), marks, lambda line, mark: F.when(~F.coalesce(mark, F.lit(False)), line)), lambda line: line.isNotNull())
    kept = F.when(numbers.isNull(), body).otherwise(F.array_join(left, "\n"))
    joined = docs.join(gone, F.col(f"`{key}`").eqNullSafe(F.col(key_name)) & (F.xxhash64(body) == F.col(row_name)), "left")
    return joined.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
