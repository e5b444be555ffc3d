"""Personal data by fixed forms and by bootstrapped contexts.

Four base forms are found in every text. They are the seeds: the words around them
are lexical patterns, and tokens of an identifier's shape that stand in the same
places are instances. Patterns and instances form a graph, over the whole table;
in each round patterns are scored by the instances they hold, and instances by
their patterns. Instances that end up nearly certain become seeds of further
patterns, until none is added; they are found wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.session import durable, ship_package

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number that fails as a whole fails from each of its later digits too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# What makes a token look like an identifier, and a group of a number written in groups.
_SIGN = re.compile(r"[0-9@]|(?<=[A-Za-z])\.(?=[A-Za-z])|(?i:[(\[{<](?:at|dot)[)\]}>])")
_END = re.compile(r"\s")
_GROUP = re.compile(r"[(+]*[0-9][0-9()./-]*")
_JOINT = re.compile(r"[ \u00a0-]{1,3}")
_EDGE = "\"'`.,;:!?()[]{}<>|*#%&$"

# Longest token that can be an instance, and the stretches that hold its context.
LONGEST, BEFORE, AFTER = 64, 80, 40
# Digits of the longest number written in groups, those of a card.
MOST_DIGITS = 19

_SCAN = "row bigint, id bigint, spans array<struct<kind:string,start:int,end:int>>, slots array<struct<start:int,end:int,kind:string,instance:string,patterns:array<string>>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The domain is searched, and the local part is what stands before its sign."""
    end = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            end = found.end()
            yield start, end


def _luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base forms, in code points, by kind and start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for found in _IP.finditer(text):
        parts = (p.lstrip("0") for p in found[0].split("."))
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            spans.append(("ip", *found.span()))
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *found.span()))
    for found in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
            spans.append(("phone", *found.span()))
    return spans


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The two words before a place, and the words on either side of it."""
    plain = [re.sub(r"[0-9]", "9", w.strip(_EDGE).lower()) for w in text[max(0, start - BEFORE) : start].split()[-2:]]
    after = [w.strip(_EDGE).lower() for w in text[end : end + AFTER].split()[:1]]
    found = []
    if len(plain) == 2:
        found.append(f"{plain[0]} {plain[1]} _")
    if plain and after:
        found.append(f"{plain[-1]} _ {after[0]}")
    return found


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Blank-free tokens that hold a digit or a sign of an address."""
    end = 0
    while sign := _SIGN.search(text, end):
        start = sign.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        blank = _END.search(text, sign.end())
        end = blank.start() if blank else len(text)
        yield start, end


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A stretch without the punctuation around it; brackets that close inside it stay."""
    a, b = start, end
    while a < b and text[a] in _EDGE:
        a += 1
    while b > a and text[b - 1] in _EDGE:
        b -= 1
    if b - a <= LONGEST:
        if a > start and text[a - 1] == "(" and text.count(")", a, b) > text.count("(", a, b):
            a -= 1
        if b < end and text[b] == ")" and text.count("(", a, b) > text.count(")", a, b):
            b += 1
    return a, b


def _slots(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str | None, str, list[str]]]:
    """Seeds, and what else looks like identifiers: tokens and numbers written in groups.

    A number goes from each of its groups to its last one, as a group before it may
    be another number.
    """
    found = [(a, b, kind, text[a:b].lower(), _patterns(text, a, b)) for kind, a, b in spans if b - a <= LONGEST]
    taken = sorted((a, b) for _, a, b in spans)
    tokens, k = [], 0
    for start, end in _tokens(text):
        a, b = _trimmed(text, start, end)
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if 0 < b - a <= LONGEST and not (k < len(taken) and taken[k][0] < b):
            digits = sum(c.isdigit() for c in text[a:b]) if _GROUP.fullmatch(text, a, b) else 0
            tokens.append((start, end, a, b, digits))
    for i, (start, _, a, b, digits) in enumerate(tokens):
        j, last = i, b
        while digits and j + 1 < len(tokens):
            before, after = tokens[j], tokens[j + 1]
            digits += after[4]
            # Other punctuation than brackets parts numbers.
            joined = text[before[3] : before[1]].strip(")") == "" and text[after[0] : after[2]].strip("(") == "" and _JOINT.fullmatch(text, before[1], after[0])
            if not joined or not after[4] or digits > MOST_DIGITS or after[3] - a > LONGEST:
                break
            j, last = j + 1, after[3]
        if j > i:
            a, last = _trimmed(text, start, tokens[j][1])
            if last - a > LONGEST:
                a, last = tokens[i][2], tokens[j][3]
        found.append((a, last, None, text[a:last].lower(), _patterns(text, a, last)))
    return found


def _scanned(docs: DataFrame) -> DataFrame:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    slot = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, slots = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                slots.append([dict(zip(("start", "end", "kind", "instance", "patterns"), s)) for s in _slots(text, base)])
            arrays = [batch.column("row"), batch.column("id"), pa.array(spans, pa.list_(span)), pa.array(slots, pa.list_(slot))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "spans", "slots"])

    return docs.mapInArrow(run, _SCAN)


def discovered(scanned: DataFrame, rounds: int, support: int, certain: float) -> DataFrame:
    """(instance, kind, score) of the instances that the graph makes certain.

    An edge is an instance, a pattern and how often they met; repeated copies of a
    text add to that count but not to a pattern's support, which counts different
    seeds. A pattern's score for a kind is the belief in its instances over their
    number plus one; an instance's score is the chance that one of its patterns is
    right, were they independent. Seeds are believed fully for their own kind.

    Scores settle in ``rounds`` rounds. Instances that then are certain join the
    seeds, patterns are counted anew, and so on until no instance is added.
    """
    slots = scanned.select(F.explode("slots").alias("s")).select("s.*")
    edges = slots.select("instance", "kind", F.explode("patterns").alias("pattern"))
    edges = durable(edges.groupBy("instance", "kind", "pattern").agg(F.count("*").alias("times")))
    labelled, found = edges.select("instance", "kind", "pattern"), None
    while True:
        new = _certain(labelled, rounds, support, certain)
        if new is None:
            break
        found = new if found is None else durable(found.unionByName(new))
        known = found.select("instance", F.col("kind").alias("_of"))
        labelled = durable(
            edges.join(known, "instance", "left").select("instance", F.coalesce("kind", "_of").alias("kind"), "pattern").distinct()
        )
    return edges.sparkSession.createDataFrame([], "instance string, kind string, score double") if found is None else found


def _certain(edges: DataFrame, rounds: int, support: int, certain: float) -> DataFrame | None:
    """(instance, kind, score) of the instances without a kind that become certain, or None."""
    # A pattern's edges count once. Only patterns with enough different seeds of one kind go on.
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("held"), *counts)
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("of"), F.col(k).alias("seeds")) for k in KINDS))).alias("k")
    strong = durable(sizes.select("pattern", "held", kinds).select("pattern", "k.of", "k.seeds", "held").where(F.col("seeds") >= support))
    others = durable(edges.where("kind IS NULL").select("instance", "pattern").join(strong.select("pattern", "of"), "pattern"))
    if others.isEmpty():
        return None
    scores = None
    for _ in range(rounds):
        belief = strong.select("pattern", "of", "held", F.col("seeds").cast("double").alias("sum"))
        if scores is not None:
            gained = others.join(scores.withColumnRenamed("kind", "of"), ["instance", "of"]).groupBy("pattern", "of").agg(F.sum("score").alias("more"))
            belief = belief.join(gained, ["pattern", "of"], "left").withColumn("sum", F.col("sum") + F.coalesce("more", F.lit(0.0)))
        rated = belief.select("pattern", "of", (F.col("sum") / (F.col("held") + 1)).alias("p"))
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("p")))))
        scores = durable(others.join(rated, ["pattern", "of"]).groupBy("instance", F.col("of").alias("kind")).agg((1 - doubt).alias("score")))
    best = scores.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b"))
    new = durable(best.select("instance", "b.kind", "b.score").where(F.col("score") >= certain))
    return None if new.isEmpty() else new


def _listed(spans: Column) -> Column:
    """kind:start:end, by kind as listed and then by place."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), s.kind).alias("k"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data(
    docs: DataFrame, rounds: int = 3, support: int = 5, certain: float = 0.95, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, base, found) for every row: base spans, and those that contexts add.

    Spans are (kind, start, end) in code points, end exclusive. Added spans never
    touch a base span, and have the kind of the seeds whose patterns led to them.
    ``support`` is how many different seeds of a kind a pattern needs, instances
    that were found before included. What can be found are blank-free tokens with a
    digit, @, (at), (dot) or a dot between letters, and numbers of up to 19 digits in
    groups joined by blanks or dashes.

    A null text counts as empty: no spans. Repeated rows each get their spans; rows
    are told apart by a number of their own, so ids may be null or repeat. An
    instance is at most 64 signs long. Other columns are not looked at. No rows give
    no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text")
    )
    # Written, so that a row's number stays what it is.
    scanned = durable(_scanned(rows))
    certainly = discovered(scanned, rounds, support, certain).select("instance", F.col("kind").alias("of"))
    slots = scanned.select("row", F.explode("slots").alias("s")).where("s.kind IS NULL")
    added = slots.select("row", "s.start", "s.end", "s.instance").join(certainly, "instance")
    # Of a number and its last groups, the whole.
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("_reach", F.coalesce(F.max("end").over(earlier), F.lit(-1))).where(F.col("end") > F.col("_reach"))
    added = added.groupBy("row").agg(F.collect_list(F.struct(F.col("of").alias("kind"), "start", "end")).alias("found"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    joined = scanned.select("row", "id", "spans").join(added, "row", "left")
    return joined.select(F.col("id").alias(id_column), F.col("spans").alias("base"), F.coalesce("found", none).alias("found"))


def with_redactions(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with edits (start, end, text) that put a kind's name over each base span."""
    ship_package(docs.sparkSession)
    rest = docs.select(*(c for c in docs.columns if c != "edits"))
    place, names = rest.columns.index(text_column), [*rest.columns, "edits"]
    edit = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = [[{"start": a, "end": b, "text": f"[{kind}]"} for kind, a, b in base_spans(x.as_py() or "")] for x in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, pa.list_(edit))], names=names)

    kind = T.DataType.fromDDL("array<struct<start:int,end:int,text:string>>")
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("edits", kind)]))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base spans, the hash of their list, and the list of all spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select(
        id_column,
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "found")).alias("spans"),
        F.size("found").cast("bigint").alias("n_added"),
    )
