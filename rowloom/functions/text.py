"""Text rules as column expressions. Everything here but pages to markdown (see ``markdown``) runs inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.markdown import article_markdown, html_to_markdown  # noqa: F401

# The patterns below must match the rules they implement. Texts may be long and
# hold anything, so each pattern is written to read a text a bounded number of times: nothing
# rescans to the end of the text from many starting points.
BLANKS = "[ \\t\\r\\n]+"
INLINE_IMAGE = "data:image/[a-zA-Z]+;base64,[A-Za-z0-9+/=\\n]+"
INLINE_IMAGE_ONE_LINE = "data:image/[a-zA-Z]+;base64,[A-Za-z0-9+/=]+"
# A mail name starts where a run of its characters does, or where the last match ended.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\\.[A-Za-z][A-Za-z]+"
IPV4 = "[0-9]{1,3}(\\.[0-9]{1,3}){3}"
# Neither starts at a date such as 2024-01-31 nor inside one.
PHONE = "(?<![0-9])(?<![0-9]-)(?![0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]))[+]?[0-9][0-9 ()-]{7,}[0-9]"
NUMBER = "[0-9]+(?:[.,][0-9]+)*"
# House number, one to three capitalised words, kind of street.
ADDRESS = (
    "[0-9]{1,5} (?:[A-Z][a-z]{1,30} ){1,3}"
    "(?:Avenue|Ave|Boulevard|Blvd|Court|Ct|Drive|Dr|Lane|Ln|Place|Pl|Road|Rd|Square|Sq|Street|St|Way)\\b"
)
ENTITY_PATTERNS = {"email": EMAIL, "ip": IPV4, "address": ADDRESS, "phone": PHONE, "number": NUMBER}
# A name is masked where no letter, digit or underscore touches it.
_BEFORE_NAME, _AFTER_NAME = "(?<![\\p{L}\\p{N}_])", "(?![\\p{L}\\p{N}_])"
NAME_WORD = "[\\p{L}\\p{N}_]+"
# What a text must contain to hold an entity at all, where one plain search can tell.
ENTITY_MARKS = {"email": "@"}

# Marks a section start between the two passes of split_sections.
_SECTION_MARK = "\u0001"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Whitespace-separated words, without empty ones. NULL in, NULL out."""
    return F.array_remove(F.split(text, BLANKS), "")


def strip_blanks(text: Column) -> Column:
    return F.trim(text, F.lit(" \t\r\n"))


def strip_inline_images(text: Column, stop_at_newline: bool = False) -> Column:
    """Delete base64 images. A newline belongs to the image unless ``stop_at_newline``."""
    image = INLINE_IMAGE_ONE_LINE if stop_at_newline else INLINE_IMAGE
    # A plain search first, so that texts without an image skip the pattern.
    return let(
        text, lambda t: F.when(F.contains(t, F.lit("data:image/")), F.regexp_replace(t, image, "")).otherwise(t)
    )


def newline_to_break(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("<br/>"))


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def rewrite_prefix(url: Column, old: str, new: str) -> Column:
    """Replace a mirror's address, at the start of ``url`` only, by another one."""
    return F.when(F.startswith(url, F.lit(old)), F.concat(F.lit(new), F.substr(url, F.lit(len(old) + 1)))).otherwise(url)


def status_matches(status: Column, wanted: str) -> Column:
    """Case-insensitive substring test on a status text."""
    return F.contains(F.upper(status), F.lit(wanted.upper()))


# --- masking and extraction -------------------------------------------------------------


def _where_marked(text: Column, kind: str, found: Callable[[Column], Column], nothing: Callable[[Column], Column]) -> Column:
    """``found(text)`` if the text may hold an entity of the kind, else ``nothing(text)``, which costs less."""
    mark = ENTITY_MARKS.get(kind)
    if mark is None:
        return found(text)
    return let(text, lambda t: F.when(F.contains(t, F.lit(mark)), found(t)).otherwise(nothing(t)))


def mask_entities(text: Column, kinds: list[str], names: list[str] | None = None) -> Column:
    """Replace each entity of the given kinds by ``[kind]``, kind after kind; name ``number`` last, as it takes any digits.

    Persons and places have no pattern, so they come from ``names``, a short dictionary the caller
    supplies, whole words only; longer names win over their prefixes. ``operators.relational.mask_names`` takes any dictionary.
    """
    for kind in kinds:
        pattern, mask = ENTITY_PATTERNS[kind], f"[{kind}]"
        text = _where_marked(text, kind, lambda t, p=pattern, m=mask: F.regexp_replace(t, p, m), lambda t: t)
    if names:
        text = mask_listed(text, F.array(*[F.lit(n) for n in names]))
    return text


def mask_listed(text: Column, names: Column) -> Column:
    """Replace the names of an array column by ``[name]`` where they are whole words, longer ones first."""
    # Ends a quotation where a name itself holds the mark that does so.
    quoted = F.transform(names, lambda n: F.struct((-F.length(n)).alias("l"), F.replace(n, F.lit("\\E"), F.lit("\\E\\\\E\\Q")).alias("n")))
    either = F.array_join(F.transform(F.array_sort(quoted), lambda q: F.concat(F.lit("\\Q"), q["n"], F.lit("\\E"))), "|")
    pattern = F.concat(F.lit(f"{_BEFORE_NAME}(?:"), either, F.lit(f"){_AFTER_NAME}"))
    return F.when(F.size(names) > 0, F.regexp_replace(text, pattern, F.lit("[name]"))).otherwise(text)


def extract_entities(text: Column, kind: str) -> Column:
    """All entities of one kind, sorted; NULL for a NULL text."""
    pattern = F.lit(ENTITY_PATTERNS[kind])
    return _where_marked(
        text,
        kind,
        lambda t: F.array_sort(F.regexp_extract_all(t, pattern, F.lit(0))),
        lambda t: F.when(t.isNotNull(), F.array().cast("array<string>")),
    )


# --- web pages --------------------------------------------------------------------------


def first_element(html: Column, tag: str, attribute: str | None = None) -> Column:
    """Inner HTML of the first ``tag`` (optionally: the first that carries ``attribute``), nested ones of its kind included.

    NULL when there is none. An element that is never closed reaches to the end.
    """
    carry = f"\\s[^<>]*{attribute}[^<>]*" if attribute else "(?:\\s[^<>]*)?"
    after = F.regexp_substr(html, F.lit(f"(?is)<{tag}{carry}>.*"))
    inner = F.regexp_replace(after, "(?s)^<[^<>]*>", "")

    def closed(rest: Column) -> Column:
        # Pieces start at the tags of this kind; the first one lies before any of them.
        pieces = F.split(F.concat(F.lit(" "), rest), f"(?i)(?=<{tag}[\\s>]|</{tag}[\\s>])")
        start = F.struct(F.lit(1).alias("depth"), F.lit(-1).alias("chars"))

        def add(acc: Column, piece: Column) -> Column:
            step = F.when(F.startswith(piece, F.lit("</")), -1).when(F.startswith(piece, F.lit("<")), 1).otherwise(0)
            return F.when(acc["depth"] == 0, acc).otherwise(
                let(
                    acc["depth"] + step,
                    lambda depth: F.struct(
                        depth.alias("depth"),
                        (acc["chars"] + F.when(depth > 0, F.length(piece)).otherwise(0)).alias("chars"),
                    ),
                )
            )

        return F.aggregate(pieces, start, add, lambda acc: F.substr(rest, F.lit(1), acc["chars"]))

    return let(inner, closed)


def article_body(html: Column) -> Column:
    """Trimmed inner HTML of the first ``<div>`` marked as the article's body."""
    return strip_blanks(first_element(html, "div", 'itemprop="articleBody"'))


# --- chunking ---------------------------------------------------------------------------


def word_windows(tokens: Column, size: int, overlap: int, min_tokens: int) -> Column:
    """Overlapping windows of ``size`` words as ``array<struct<pos, n_words, content>>``.

    Window starts lie ``size - overlap`` apart; windows of ``min_tokens`` words or fewer are
    dropped, but ``pos`` counts them.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")

    def windows(token: Column, n: Column) -> Column:
        last = F.ceil(F.greatest(n, F.lit(1)) / F.lit(step)).cast("int") - 1
        kept = F.filter(F.sequence(F.lit(0), last), lambda pos: n - pos * step > min_tokens)
        return F.transform(
            kept,
            lambda pos: F.struct(
                pos.alias("pos"),
                F.least(F.lit(size), n - pos * step).alias("n_words"),
                F.array_join(F.slice(token, pos * step + 1, F.lit(size)), " ").alias("content"),
            ),
        )

    return let(tokens, lambda token: let(F.size(token), lambda n: windows(token, n)))


def split_sections(text: Column, level: int = 2) -> Column:
    """Split markdown at headers of one level into ``header + newline + body`` texts.

    Text before the first header is a section with an empty header. A header line inside a
    fenced block is body text. Sections of blanks only are dropped.
    """
    header = "\n" + "#" * level + " "
    # Odd pieces lie inside a fence, so only even ones may start a section.
    pieces = F.split(F.concat(F.lit("\n"), text), "\\n```")
    marked = F.transform(
        pieces,
        lambda piece, i: F.when(i % 2 == 0, F.replace(piece, F.lit(header), F.lit(_SECTION_MARK + header[1:]))).otherwise(piece),
    )
    sections = F.split(F.array_join(marked, "\n```"), _SECTION_MARK + "#{" + str(level) + "} ")
    return F.filter(sections, lambda s: strip_blanks(s) != "")


def _counted(texts: Column) -> Column:
    """Each text with its number of words."""
    return F.transform(texts, lambda s: F.struct(s.alias("s"), F.size(words(s)).alias("n")))


def _fit_to(texts: Column, max_tokens: int, overlap: int) -> Column:
    """Cut each text of more than ``max_tokens`` words into windows; keep the others as they are."""
    return F.flatten(
        F.transform(
            texts,
            lambda text: let(
                words(text),
                lambda token: F.when(F.size(token) <= max_tokens, F.array(text)).otherwise(
                    F.transform(word_windows(token, max_tokens, overlap, 0), lambda w: w["content"])
                ),
            ),
        )
    )


# A fold copies its state at each step, so long arrays are folded in blocks of this size.
_BLOCK = 200
# Begins a chunk between the two passes of merge_sections; a text's own first character of it is always followed by the other one.
_CHUNK_MARK, _CHUNK_CHAR, _ESCAPED_CHAR = "\u0001\u0003", "\u0001", "\u0001\u0002"


def _chunk_starts(counts: Column, max_tokens: int) -> Column:
    """Whether each section begins a chunk, from the numbers of words alone."""
    none = F.array().cast("array<boolean>")

    def add(acc: Column, n: Column) -> Column:
        fits = acc["n"] + n <= max_tokens / 2
        return F.struct(
            F.array_append(acc["starts"], ~fits).alias("starts"), F.when(fits, acc["n"] + n).otherwise(n).alias("n")
        )

    def add_block(acc: Column, block: Column) -> Column:
        start = F.struct(none.alias("starts"), acc["n"].alias("n"))
        return F.aggregate(
            block,
            start,
            add,
            lambda found: F.struct(F.concat(acc["starts"], found["starts"]).alias("starts"), found["n"].alias("n")),
        )

    def whole(counts: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(counts) / _BLOCK).cast("int")),
            lambda i: F.slice(counts, i * _BLOCK + 1, F.lit(_BLOCK)),
        )
        return F.aggregate(blocks, F.struct(none.alias("starts"), F.lit(0).alias("n")), add_block, lambda acc: acc["starts"])

    return let(counts, whole)


def merge_sections(sections: Column, max_tokens: int) -> Column:
    """Greedily merge neighbouring sections while they hold at most half of ``max_tokens``.

    A section that does not fit closes the running chunk and starts the next one. The time grows with the text.
    """

    def merged(counted: Column) -> Column:
        marked = F.zip_with(
            F.transform(counted, lambda x: F.replace(x["s"], F.lit(_CHUNK_CHAR), F.lit(_ESCAPED_CHAR))),
            _chunk_starts(F.transform(counted, lambda x: x["n"]), max_tokens),
            lambda s, starts: F.concat(F.when(starts, _CHUNK_MARK).otherwise(""), s, F.lit("\n")),
        )
        chunks = F.split(F.array_join(marked, ""), _CHUNK_MARK)
        return F.transform(chunks, lambda c: strip_blanks(F.replace(c, F.lit(_ESCAPED_CHAR), F.lit(_CHUNK_CHAR))))

    return F.array_remove(let(_counted(sections), merged), "")


def markdown_chunks(text: Column, max_tokens: int = 500, overlap: int = 50, min_tokens: int = 20, level: int = 2) -> Column:
    """Inline images out, split at headers, merge small sections, window large ones.

    Returns ``array<string>`` with every chunk of more than ``min_tokens`` words.
    """
    clean = strip_inline_images(F.coalesce(text, F.lit("")))
    pieces = _fit_to(merge_sections(split_sections(clean, level), max_tokens), max_tokens, overlap)
    return F.filter(pieces, lambda chunk: F.size(words(chunk)) > min_tokens)


def sentences(text: Column) -> Column:
    """Sentences: a full stop, question or exclamation mark and blanks end one."""
    return F.array_remove(F.split(text, "(?<=[.!?])" + BLANKS), "")


def _chunk_ranges(counts: Column, max_tokens: int, overlap: int) -> Column:
    """First unit and the one behind the last of each chunk, from the numbers of words alone.

    A unit has a word at least, but for a text of blanks, so a repeated tail has at most ``overlap`` units.
    """
    none = F.array().cast("array<struct<first:int,end:int>>")

    def held(first: Column, end: Column) -> Column:
        return F.aggregate(F.slice(counts, first + 1, end - first), F.lit(0), lambda total, n: total + n)

    def add(acc: Column, n: Column) -> Column:
        here = F.struct(acc["first"].alias("first"), acc["i"].alias("end"))
        room = F.least(F.lit(overlap), F.lit(max_tokens) - n)
        # Where the repeated tail may begin; at the unit itself it is empty.
        begins = F.sequence(F.greatest(acc["first"] + 1, acc["i"] - overlap), acc["i"])
        cut = let(
            F.element_at(F.filter(begins, lambda j: held(j, acc["i"]) <= room), 1),
            lambda j: F.struct(
                F.array_append(acc["done"], here).alias("done"), j.alias("first"), (held(j, acc["i"]) + n).alias("n"), (acc["i"] + 1).alias("i")
            ),
        )
        more = F.struct(acc["done"].alias("done"), acc["first"].alias("first"), (acc["n"] + n).alias("n"), (acc["i"] + 1).alias("i"))
        return F.when((acc["n"] + n <= max_tokens) | (acc["i"] == acc["first"]), more).otherwise(cut)

    def add_block(acc: Column, block: Column) -> Column:
        start = F.struct(none.alias("done"), acc["first"].alias("first"), acc["n"].alias("n"), acc["i"].alias("i"))
        return F.aggregate(
            F.slice(counts, block * _BLOCK + 1, F.lit(_BLOCK)),
            start,
            add,
            lambda found: F.struct(
                F.concat(acc["done"], found["done"]).alias("done"), found["first"].alias("first"), found["n"].alias("n"), found["i"].alias("i")
            ),
        )

    zero = F.lit(0)
    return F.aggregate(
        F.sequence(F.lit(0), F.floor(F.size(counts) / _BLOCK).cast("int")),
        F.struct(none.alias("done"), zero.alias("first"), zero.alias("n"), zero.alias("i")),
        add_block,
        lambda acc: F.when(acc["i"] == 0, acc["done"]).otherwise(
            F.array_append(acc["done"], F.struct(acc["first"].alias("first"), acc["i"].alias("end")))
        ),
    )


def sentence_chunks(text: Column, max_tokens: int = 500, overlap: int = 10) -> Column:
    """Pack whole sentences into chunks of at most ``max_tokens`` words, as ``array<string>``.

    Each next chunk first repeats the trailing sentences of the last one that together hold at
    most ``overlap`` words and leave room for the next sentence. A sentence longer than a
    chunk is cut into word windows of the chunk size first. Chunks are found as ranges of sentences
    and their texts joined once, so the time grows with the text.
    """
    units = _counted(_fit_to(sentences(F.coalesce(text, F.lit(""))), max_tokens, 0))

    def joined(counted: Column) -> Column:
        texts = F.transform(counted, lambda x: x["s"])
        ranges = let(F.transform(counted, lambda x: x["n"]), lambda counts: _chunk_ranges(counts, max_tokens, overlap))
        return let(texts, lambda strings: F.transform(ranges, lambda r: F.array_join(F.slice(strings, r["first"] + 1, r["end"] - r["first"]), " ")))

    return let(units, joined)
