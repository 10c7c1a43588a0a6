"""Labelled spans of documents: phrases, heading runs, bold titles, noise, text lines, paragraphs.

All spans of a text are found and resolved within its row: lines, candidates and
what is chosen of them are arrays of the row, neighbours are looked up by place,
and only the result is exploded.  So one scan of the documents does it, nothing
is shuffled, and a row is labelled by itself: rows that repeat a key, or have
none, each have the spans that they would have alone.

Spans are structs (start, end, label); arrays of them are in order of start.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions import predicates as P
from spanforge.functions import vocabulary as V
from spanforge.functions.text import strip
from spanforge.operators.lines import before, bound, line_array, starts_of

SPANS = "array<struct<start:bigint,end:bigint,label:string>>"
#: Kinds of lines.
TEXT, PLAIN_HEAD, STAR_HEAD = 0, 1, 2


def _span(start: Column, end: Column, label: Column | str) -> Column:
    return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), (F.lit(label) if isinstance(label, str) else label).alias("label"))


def _none() -> Column:
    return F.array().cast(SPANS)


def _texts(docs: DataFrame, key: str) -> DataFrame:
    return docs.where(F.col("text").isNotNull()).select(F.col(key).alias("_key"), F.col("text").alias("_text"))


def _rows(rows: DataFrame, spans: Column | str, key: str) -> DataFrame:
    """A row for each struct of an array.

    The outer form, as the plain one would put a filter on the size of the array
    below everything that the array is made of, and so make it twice.
    """
    return rows.select(F.col("_key").alias(key), F.inline_outer(spans)).where("start is not null")


def _exploded(rows: DataFrame, spans: str, key: str) -> DataFrame:
    return _rows(rows, spans, key).select(key, "label", "start", "end")


def phrase_spans(text: Column, wanted: dict[str, str] | None = None) -> Column:
    """Every place of each fixed phrase, by phrase: the text is split at it and lengths add up."""
    wanted = wanted or V.PHRASES

    def places(phrase: str, label: str) -> Column:
        pieces = F.split(text, "\\Q" + phrase + "\\E", -1)
        lengths = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: F.length(x).cast("bigint") + len(phrase))
        begins = F.zip_with(starts_of(lengths), lengths, lambda s, n: s + n - len(phrase))
        return F.when(text.contains(phrase), F.transform(begins, lambda s: _span(s, s + len(phrase), label))).otherwise(_none())

    some = reduce(Column.__or__, (text.contains(p) for p in wanted))
    return F.when(some, F.concat(*(places(*x) for x in wanted.items()))).otherwise(_none())


def visible_lines(text: Column) -> Column:
    """Lines that are not blank (line_no, start, line, kind), without outer white space."""
    shown = F.filter(F.transform(line_array(text), lambda x, i: F.struct(i.alias("line_no"), x["start"].alias("start"), x["line"].alias("line"))), lambda x: x["line"].rlike(r"(?U)\S"))
    lead = lambda line: F.when(line.rlike(r"(?U)^\s"), F.length(line) - F.length(F.regexp_replace(line, r"(?U)^\s+", ""))).otherwise(0)
    bare = lambda line: F.when(line.rlike(r"(?U)^\s|\s\z"), strip(line)).otherwise(line)
    kind = lambda line: F.when(P.is_org_line(line), F.when(P.has_star(line), STAR_HEAD).otherwise(PLAIN_HEAD)).otherwise(TEXT)
    return F.transform(shown, lambda x: F.struct(x["line_no"].alias("line_no"), (x["start"] + lead(x["line"])).alias("start"), bare(x["line"]).alias("line"), kind(x["line"]).alias("kind")))


def _end(line: Column) -> Column:
    return line["start"] + F.length(line["line"])


def run_spans(lines: Column) -> Column:
    """Islands of consecutive heading lines of one kind (with or without a star), from first to last visible character; with n_lines."""

    def goes_on(a: Column, b: Column) -> Column:
        return F.coalesce((a["line_no"] + 1 == b["line_no"]) & (a["kind"] == b["kind"]), F.lit(False))

    first = F.filter(lines, lambda x, i: (x["kind"] != TEXT) & ~goes_on(F.get(lines, i - 1), x))
    last = F.filter(lines, lambda x, i: (x["kind"] != TEXT) & ~goes_on(x, F.get(lines, i + 1)))
    label = lambda x: F.when(x["kind"] == STAR_HEAD, V.ORG_STAR).otherwise(V.ORG)
    return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), _end(b).alias("end"), label(a).alias("label"), (b["line_no"] - a["line_no"] + 1).cast("bigint").alias("n_lines")))


def bold_spans(text: Column) -> Column:
    """Blocks of bold text (start, end, content): marks are paired in order, and pairs with only same-line spaces between are one block."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,content:string>>")

    def blocks(pieces: Column, begins: Column) -> Column:
        joined = lambda i: (i > 1) & F.get(pieces, i - 1).rlike(r"(?U)^[\s&&[^\n]]*\z")
        closed = F.size(pieces) - 2  # the last piece that may be bold
        odd = F.when(closed >= 1, F.sequence(F.lit(1), closed, F.lit(2))).otherwise(F.array().cast("array<int>"))
        first = F.filter(odd, lambda i: ~joined(i))
        last = F.filter(odd, lambda i: (i + 2 > closed) | ~joined(i + 2))
        return F.zip_with(
            first,
            last,
            lambda a, b: F.struct(
                (F.get(begins, a) - 2).alias("start"), (F.get(begins, b) + F.length(F.get(pieces, b)) + 2).alias("end"), F.array_join(F.slice(pieces, a + 1, b - a + 1), "**").alias("content")
            ),
        )

    lengths = lambda pieces: F.transform(pieces, lambda x: F.length(x).cast("bigint") + 2)
    found = bound(F.split(text, r"\*\*", -1), lambda pieces: bound(starts_of(lengths(pieces)), lambda begins: blocks(pieces, begins)))
    return F.when(text.contains("**"), found).otherwise(empty)


def title_spans(text: Column) -> Column:
    return F.transform(F.filter(bold_spans(text), lambda b: P.is_title_bold(b["content"])), lambda b: _span(b["start"], b["end"], V.TITLE))


def resolved(*rules: Column) -> Column:
    """Greedy choice among the spans of several rules: the longest first, ties by start and then the order of rules, each kept if it overlaps none kept.

    Spans that overlap, at first or second hand, are an island; islands do not
    touch one another, so each is resolved alone.
    """

    def ranked(rule: Column, rank: int) -> Column:
        return F.transform(rule, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank"), s["label"].alias("label")))

    every = F.concat(*(ranked(rule, n) for n, rule in enumerate(rules)))

    def islands(spans: Column) -> Column:
        reach = before(F.transform(spans, lambda s: s["end"]), F.lit(0).cast("bigint"), lambda x, y: F.greatest(x, y))
        opens = bound(reach, lambda ends: F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: F.get(spans, i)["start"] >= F.get(ends, i)))
        return bound(opens, lambda at: F.transform(at, lambda i, n: F.slice(spans, i + 1, F.coalesce(F.get(at, n + 1), F.size(spans)) - i)))

    def chosen(island: Column) -> Column:
        first = F.array_sort(F.transform(island, lambda s: F.struct((s["start"] - s["end"]).alias("less"), s["start"].alias("start"), s["rank"].alias("rank"), s["label"].alias("label"), s["end"].alias("end"))))

        def step(kept: Column, s: Column) -> Column:
            clash = F.exists(kept, lambda k: (k["start"] < s["end"]) & (k["end"] > s["start"]))
            return F.when(clash, kept).otherwise(F.array_append(kept, _span(s["start"], s["end"], s["label"])))

        alone = F.transform(island, lambda s: _span(s["start"], s["end"], s["label"]))
        return F.when(F.size(island) == 1, alone).otherwise(F.aggregate(first, _none(), step, lambda kept: F.array_sort(kept)))

    few = lambda spans: F.when(F.size(spans) == 0, _none()).otherwise(F.flatten(F.transform(islands(spans), lambda island: chosen(island))))
    return bound(F.array_sort(every), few)


def beside(lines: Column, spans: Column) -> Column:
    """Lines that overlap none of spans, which do not overlap one another: of those that begin before a line's end, the last one, found by halving, tells."""
    powers = F.transform(F.sequence(F.floor(F.log2(F.size(spans))).cast("int"), F.lit(0)), lambda b: F.call_function("shiftleft", F.lit(1), b))

    def n_before(end: Column, steps: Column) -> Column:
        nearer = lambda at, step: F.when(F.coalesce(F.get(spans, at + step - 1)["start"] < end, F.lit(False)), at + step).otherwise(at)
        return F.aggregate(steps, F.lit(0), nearer)

    free = lambda x, steps: F.coalesce(F.get(spans, n_before(_end(x), steps) - 1)["end"] <= x["start"], F.lit(True))
    return F.when(F.size(spans) == 0, lines).otherwise(bound(powers, lambda steps: F.filter(lines, lambda x: free(x, steps))))


def _look(line: Column) -> Column:
    """What merging needs of a text line."""
    return F.struct(P.ends_sentence(line).alias("ended"), P.starts_lower(line).alias("lower"), P.starts_upper(line).alias("upper"))


def _stream(lines: Column, spans: Column) -> Column:
    """The spans, and the lines beside them as noise or text, in order: start, end, label, look (null but for text)."""
    marked = F.transform(beside(lines, spans), lambda x: F.struct(x["start"].alias("start"), _end(x).alias("end"), F.when(P.is_junk_line(x["line"]), V.JUNK).otherwise(V.BODY).alias("label"), x["line"].alias("line")))
    looked = F.transform(marked, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["label"].alias("label"), F.when(x["label"] == V.BODY, _look(x["line"])).alias("look")))
    fixed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"), F.lit(None).cast("struct<ended:boolean,lower:boolean,upper:boolean>").alias("look")))
    return F.array_sort(F.concat(fixed, looked))


def paragraph_spans(stream: Column) -> Column:
    """All spans of a text in order, with text lines merged into paragraphs.

    A run goes on from a text line to the next span if that is a text line too
    and the sentence goes on (no end mark, or a lower-case start).  Leading lines
    of a run that start in lower case stay single.  Runs of one line stay text
    lines.
    """

    def breaks(x: Column, i: Column) -> Column:
        last = F.get(stream, i - 1)["look"]
        return last.isNull() | x["look"].isNull() | (last["ended"] & ~x["look"]["lower"])

    every = F.sequence(F.lit(0), F.size(stream) - 1)
    opens = F.filter(every, lambda i: breaks(F.get(stream, i), i))

    def merged(run: Column) -> Column:
        single = lambda s: _span(s["start"], s["end"], s["label"])
        first = F.array_position(F.transform(run, lambda s: F.coalesce(s["look"]["upper"], F.lit(False))), F.lit(True)).cast("int")
        label = lambda at: F.when(F.size(run) > at, V.PARAGRAPH).otherwise(V.BODY)
        rest = lambda at: F.array(_span(F.get(run, at - 1)["start"], F.element_at(run, -1)["end"], label(at)))
        joined = bound(first, lambda at: F.when(at == 0, F.transform(run, single)).otherwise(F.concat(F.transform(F.slice(run, F.lit(1), at - 1), single), rest(at))))
        return F.when(F.size(run) == 1, F.transform(run, single)).otherwise(joined)

    runs = bound(opens, lambda at: F.transform(at, lambda i, n: F.slice(stream, i + 1, F.coalesce(F.get(at, n + 1), F.size(stream)) - i)))
    return F.when(F.size(stream) == 0, _none()).otherwise(F.flatten(F.transform(runs, lambda run: merged(run))))


def _with_lines(docs: DataFrame, key: str) -> DataFrame:
    return _texts(docs, key).withColumn("_lines", visible_lines(F.col("_text")))


def _with_stream(docs: DataFrame, key: str) -> DataFrame:
    """Spans of phrases, headings and titles, each rule resolved against what stands, and the lines beside them."""
    rows = _with_lines(docs, key)
    rows = rows.withColumn("_headed", resolved(phrase_spans(F.col("_text")), run_spans(F.col("_lines")))).withColumn("_chosen", resolved(F.col("_headed"), title_spans(F.col("_text"))))
    return rows.select("_key", "_text", _stream(F.col("_lines"), F.col("_chosen")).alias("_stream"))


def heading_runs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, label, start, end, n_lines of every heading run."""
    return _rows(_with_lines(docs, key), run_spans(F.col("_lines")), key).select(key, "label", "start", "end", "n_lines")


def bold_blocks(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, start, end, content of every block of bold text."""
    return _rows(_texts(docs, key), bold_spans(F.col("_text")), key)


def phrases(docs: DataFrame, key: str = "doc_id", wanted: dict[str, str] | None = None) -> DataFrame:
    """key, label, start, end of every place of a fixed phrase."""
    return _exploded(_texts(docs, key).select("_key", phrase_spans(F.col("_text"), wanted).alias("_spans")), "_spans", key)


def headings_and_titles(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Heading runs and bold titles, resolved in one go: key, label, start, end."""
    return _exploded(_with_lines(docs, key).select("_key", resolved(run_spans(F.col("_lines")), title_spans(F.col("_text"))).alias("_spans")), "_spans", key)


def labelled_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Spans of phrases, headings and titles, resolved, and the lines beside them as noise or text: key, label, start, end, look (of text only)."""
    return _rows(_with_stream(docs, key), "_stream", key).select(key, "label", "start", "end", "look")


def label(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """All spans of docs (key, text): key, label, start, end; those of a row do not overlap."""
    return _exploded(_with_stream(docs, key).select("_key", paragraph_spans(F.col("_stream")).alias("_spans")), "_spans", key)


def numbered(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """All spans of docs with their order in the row and their text: key, seq, label, text, start, end."""
    rows = _with_stream(docs, key).select("_key", "_text", F.posexplode_outer(paragraph_spans(F.col("_stream"))).alias("_at", "_s")).where("_at is not null")
    shown = F.substring("_text", (F.col("_s.start") + 1).cast("int"), (F.col("_s.end") - F.col("_s.start")).cast("int"))
    return rows.select(F.col("_key").alias(key), (F.col("_at") + 1).alias("seq"), F.col("_s.label").alias("label"), shown.alias("text"), F.col("_s.start").alias("start"), F.col("_s.end").alias("end"))
