"""Text rules over documents and pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowloom.functions import text as text_fn
from rowloom.operators import chunking, inference, relational
from rowloom.plans.registry import query, table, words_sql
from rowloom.session import scratch_path, spread
from rowloom.sources import web
from rowloom.sources.commits import CommittedTable
from rowloom.sources.tables import create_chunk_table


def documents(spark, folder, *columns):
    """Documents spread over all cores, for costly work per row."""
    return spread(table(spark, folder, "documents").select("doc_id", *columns), "doc_id")


def pages(spark, folder):
    return spread(table(spark, folder, "pages"), "page_id")


@query("SELECT doc_id, length(replace(text, chr(10), '<br/>')) AS n, md5(replace(text, chr(10), '<br/>')) AS h FROM documents")
def text_to_html(spark, folder):
    html = documents(spark, folder, "text").select("doc_id", text_fn.newline_to_break(F.col("text")).alias("html"))
    return html.select("doc_id", F.length("html").cast("long").alias("n"), F.md5("html").alias("h"))


# The page rules once more, step by step, as SQL.
_MARKDOWN_STEPS = [
    (r"(?is)<script[^<>]*>.*?(?:</script>|\z)", ""),
    (r"(?is)<style[^<>]*>.*?(?:</style>|\z)", ""),
    (r"(?s)<!--.*?(?:-->|\z)", ""),
    (r"[ \t\r\n]+", " "),
    *[(rf"(?i)<h{n}(?: [^<>]*)?>", "\n\n" + "#" * n + " ") for n in range(1, 7)],
    (r"(?i)</h[1-6]>", "\n\n"),
    (r"(?i)<li(?: [^<>]*)?>", "\n* "),
    (r"(?i)<br[^<>]*>", "\n"),
    (r"(?i)</?p(?: [^<>]*)?>", "\n\n"),
    (r"(?i)<(?:i|em)>([^<]*)</(?:i|em)>", r"*\1*"),
    (r"(?i)<(?:b|strong)>([^<]*)</(?:b|strong)>", r"**\1**"),
    (r'(?i)<a [^<>]*href="([^"<>]*)"[^<>]*>([^<]*)</a>', r"[\2](\1)"),
    (r"<[^<>]*>", ""),
]
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]


def _markdown_sql():
    sql = "regexp_extract(html, '(?is)<article(?:\\s[^<>]*)?>(.*?)(?:</article>|\\z)', 1)"
    for pattern, replacement in _MARKDOWN_STEPS:
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    for entity, char in _ENTITIES:
        sql = f"replace({sql}, '{entity.replace(chr(39), chr(39) * 2)}', '{char}')"
    sql = f"replace(replace(regexp_replace({sql}, ' {{2,}}', ' ', 'g'), ' \n', '\n'), '\n ', '\n')"
    sql = f"regexp_replace({sql}, '\\n{{3,}}', '\n\n', 'g')"
    return f"trim({sql}, ' ' || chr(9) || chr(13) || chr(10))"


_ARTICLES_SQL = f"SELECT page_id, url, {_markdown_sql()} AS text FROM pages WHERE regexp_matches(html, '(?is)<article(\\s[^<>]*)?>')"


@query(f"SELECT page_id, length(text) AS n, md5(text) AS h FROM ({_ARTICLES_SQL})")
def extract_articles(spark, folder):
    found = web.extract_articles(pages(spark, folder))
    return found.select("page_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))


@query(
    """SELECT page_id, length(text) AS n FROM (
         SELECT page_id, trim(regexp_extract(html, '(?is)<nav(?:\\s[^<>]*)?>(.*?)(?:</nav>|\\z)', 1), ' ' || chr(9) || chr(13) || chr(10)) AS text
         FROM pages WHERE regexp_matches(html, '(?is)<nav(\\s[^<>]*)?>'))"""
)
def extract_elements(spark, folder):
    """Raw inner HTML of another element, by the rule that serves pages without an article."""
    rule = lambda html: text_fn.strip_blanks(text_fn.first_element(html, "nav"))
    found = web.extract_articles(pages(spark, folder), rule, fail_if_empty=True)
    return found.select("page_id", F.length("text").cast("long").alias("n"))


@query(
    """SELECT page_id, length(text) AS n, md5(text) AS h FROM (
         SELECT page_id, trim('<div class="head">' || url || '</div>' || html || '<div><div></div></div>', ' ' || chr(9) || chr(13) || chr(10)) AS text
         FROM pages)"""
)
def article_bodies(spark, folder):
    """Each page, with the divisions it holds, as the body of an article, and got back whole."""
    stored = pages(spark, folder)
    inner = F.concat(F.lit('<div class="head">'), "url", F.lit("</div>"), "html", F.lit("<div><div></div></div>"))
    wrapped = F.concat(F.lit('<main><div itemprop="articleBody">'), inner, F.lit("</div><div>after</div></main>"))
    found = web.extract_articles(stored.withColumn("html", wrapped), text_fn.article_body)
    return found.select("page_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))


@query(
    r"""SELECT doc_id, length(clean) AS n, md5(clean) AS h FROM (
          SELECT doc_id, regexp_replace(replace(text, '. ', '. data:image/png;base64,iVBORw0KGgo= '),
                                        'data:image/[a-zA-Z]+;base64,[A-Za-z0-9+/=\n]+', '', 'g') AS clean
          FROM documents)"""
)
def strip_inline_images(spark, folder):
    """An image put after every sentence, and taken out again."""
    image = F.lit(". data:image/png;base64,iVBORw0KGgo= ")
    docs = documents(spark, folder, "text").withColumn("text", F.replace("text", F.lit(". "), image))
    clean = docs.select("doc_id", text_fn.strip_inline_images(F.col("text")).alias("clean"))
    return clean.select("doc_id", F.length("clean").cast("long").alias("n"), F.md5("clean").alias("h"))


@query(
    """SELECT doc_id, length(text) AS n, md5(text) AS h FROM (
         SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text,
                  '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z][A-Za-z]+', '[email]', 'g'),
                  '[0-9]{1,3}(\\.[0-9]{1,3}){3}', '[ip]', 'g'),
                  '[+]?[0-9][0-9 ()-]{7,}[0-9]', '[phone]', 'g') AS text
         FROM documents)"""
)
def mask_entities(spark, folder):
    masked = documents(spark, folder, "text").select(
        "doc_id", text_fn.mask_entities(F.col("text"), ["email", "ip", "phone"]).alias("text")
    )
    return masked.select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))


@query(
    """SELECT c_custkey, regexp_replace(regexp_replace(c_name || ' lives at ' || n_name, 'NATION_[0-9]+', '[name]', 'g'),
                                        '[0-9]{9}', '[number]', 'g') AS masked
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def mask_names(spark, folder):
    """Names masked by a dictionary table: the nations."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    told = rows.select("c_custkey", F.concat("c_name", F.lit(" lives at "), "n_name").alias("masked"))
    masked = relational.mask_names(told, "masked", "c_custkey", nations, "n_name")
    return masked.withColumn("masked", F.regexp_replace("masked", "[0-9]{9}", "[number]"))


@query(
    r"""SELECT doc_id, length(masked) AS n, md5(masked) AS h FROM (
          SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
                   replace(text, '. ', ' of ' || doc_id % 997 || ' North Oak ' || CASE doc_id % 2 WHEN 0 THEN 'Street' ELSE 'Ave' END || ', ' || doc_id || '.5. '),
                   '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z][A-Za-z]+', '[email]', 'g'),
                   '[0-9]{1,5} ([A-Z][a-z]{1,30} ){1,3}(Avenue|Ave|Boulevard|Blvd|Court|Ct|Drive|Dr|Lane|Ln|Place|Pl|Road|Rd|Square|Sq|Street|St|Way)\b', '[address]', 'g'),
                   '[0-9]+([.,][0-9]+)*', '[number]', 'g') AS masked
          FROM documents)"""
)
def mask_addresses(spark, folder):
    """An address and a number put before each full stop, masked with all other numbers."""
    street = F.when(F.col("doc_id") % 2 == 0, "Street").otherwise("Ave")
    put = F.concat(F.lit(" of "), F.col("doc_id") % 997, F.lit(" North Oak "), street, F.lit(", "), "doc_id", F.lit(".5. "))
    docs = documents(spark, folder, "text").withColumn("text", F.replace("text", F.lit(". "), put))
    masked = docs.select("doc_id", text_fn.mask_entities(F.col("text"), ["email", "address", "number"]).alias("text"))
    return masked.select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))


@query(
    """SELECT doc_id, array_to_string(list_sort(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z][A-Za-z]+')), ',') AS emails
       FROM documents"""
)
def extract_entities(spark, folder):
    return documents(spark, folder, "text").select(
        "doc_id", F.array_join(text_fn.extract_entities(F.col("text"), "email"), ",").alias("emails")
    )


# Every line of a document becomes a section: its first line is the text before the first header.
def markdown(spark, folder):
    return documents(spark, folder, "text").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n## ")))


_SECTIONS_SQL = f"""SELECT doc_id, list_filter(list_transform(str_split(text, chr(10)), lambda l: len({words_sql('l')})),
                                              lambda n: n > 0) AS sizes FROM documents"""


@query(
    f"SELECT doc_id, CAST(len(sizes) AS INTEGER) AS n_sections, CAST(list_sum(sizes) AS BIGINT) AS n_words FROM ({_SECTIONS_SQL})"
)
def split_headers(spark, folder):
    sections = markdown(spark, folder).select("doc_id", text_fn.split_sections(F.col("text")).alias("sections"))
    n_words = F.aggregate("sections", F.lit(0).cast("long"), lambda acc, s: acc + F.size(text_fn.words(s)))
    return sections.select("doc_id", F.size("sections").alias("n_sections"), n_words.alias("n_words"))


@query(
    f"""WITH folded AS (
          SELECT doc_id, list_reduce(list_transform(sizes, lambda n: {{'done': CAST([] AS BIGINT[]), 'n': n}}),
                 lambda a, b: CASE WHEN a.n + b.n <= 50 THEN {{'done': a.done, 'n': a.n + b.n}}
                                   ELSE {{'done': list_append(a.done, a.n), 'n': b.n}} END) AS f
          FROM ({_SECTIONS_SQL}) WHERE len(sizes) > 0),
        pieces AS (
          SELECT doc_id, flatten(list_transform(list_append(f.done, f.n), lambda m:
                   CASE WHEN m <= 100 THEN [m] ELSE list_transform(range(0, m, 90), lambda s: least(100, m - s)) END)) AS p
          FROM folded),
        kept AS (SELECT doc_id, list_filter(p, lambda n: n > 20) AS p FROM pieces)
        SELECT doc_id, CAST(unnest(range(0, len(p))) AS INTEGER) AS pos, CAST(unnest(p) AS INTEGER) AS n_words FROM kept"""
)
def chunk_markdown(spark, folder):
    """Sections merged up to 50 words, cut to 100, chunks of more than 20 kept."""
    chunks = chunking.text_chunks(
        markdown(spark, folder), lambda text: text_fn.markdown_chunks(text, max_tokens=100, overlap=10, min_tokens=20)
    )
    return chunks.select("doc_id", "pos", F.size(text_fn.words(F.col("content"))).alias("n_words"))


def _windows_sql(source, key, size, overlap, min_tokens):
    step = size - overlap
    return f"""SELECT {key}, CAST(s // {step} AS INTEGER) AS pos, CAST(least({size}, len(w) - s) AS INTEGER) AS n_words,
                      array_to_string(list_slice(w, s + 1, s + {size}), ' ') AS content
               FROM (SELECT {key}, w, unnest(range(0, len(w), {step})) AS s
                     FROM (SELECT {key}, {words_sql('text')} AS w FROM {source}))
               WHERE len(w) - s > {min_tokens}"""


WINDOWS_SQL = _windows_sql("documents", "doc_id", 100, 10, 20)
_CHUNKS_SQL = f"SELECT doc_id, pos, n_words, md5(content) AS h FROM ({WINDOWS_SQL})"


def windows(docs):
    return chunking.window_chunks(docs, size=100, overlap=10, min_tokens=20)


@query(_CHUNKS_SQL)
def chunk_windows(spark, folder):
    return windows(documents(spark, folder, "text")).select("doc_id", "pos", "n_words", F.md5("content").alias("h"))


@query(
    f"""SELECT md5(url || chr(10) || pos) AS id, url, pos, n_words, md5(content) AS h
        FROM ({_windows_sql(f'({_ARTICLES_SQL})', 'url', 100, 10, 20)})"""
)
def chunk_table(spark, folder):
    """Pages to articles to keyed chunks."""
    articles = web.extract_articles(pages(spark, folder)).select("url", "text")
    keyed = chunking.with_chunk_id(windows(articles))
    return keyed.select("id", "url", "pos", "n_words", F.md5("content").alias("h"))


@query(
    f"""WITH c AS (SELECT url, pos, content, length(url) % 2 = 0 AS early FROM ({_windows_sql(f'({_ARTICLES_SQL})', 'url', 100, 10, 20)})),
             p AS (SELECT DISTINCT url, pos, early FROM c)
        SELECT n.id, c.url, md5(c.content) AS h FROM c JOIN (
            SELECT url, pos, row_number() OVER (ORDER BY early DESC, url, pos) AS id FROM p) n USING (url, pos)"""
)
def chunk_numbers(spark, folder):
    """A chunk table filled in two runs: pages with addresses of even length, then all. Numbers of the first run stay."""
    numbers = CommittedTable(spark, scratch_path(spark, "numbers"), chunking.NUMBERS)
    chunks = windows(web.extract_articles(pages(spark, folder)).select("url", "text"))
    chunking.with_chunk_number(chunks.where(F.length("url") % 2 == 0), numbers)
    name = f"chunks_{uuid.uuid4().hex}"
    create_chunk_table(spark, name)
    chunking.with_chunk_number(chunks, numbers).select("id", "url", "content").write.insertInto(name)
    return spark.table(name).select("id", "url", F.md5("content").alias("h"))


def _window_splitter():
    """A splitter in Python with the rule of ``windows``."""
    import re

    def cut(text):
        tokens = [w for w in re.split("[ \t\r\n]+", text) if w]
        starts = range(0, max(len(tokens), 1), 90)
        return [" ".join(tokens[s : s + 100]) for s in starts if len(tokens) - s > 20]

    return cut


@query(_CHUNKS_SQL)
def iterator_chunk(spark, folder):
    """The same chunks by a Python splitter that is set up once per task."""
    split = inference.chunk_function(_window_splitter)
    chunks = chunking.text_chunks(documents(spark, folder, "text"), split)
    return chunks.select(
        "doc_id", "pos", F.size(text_fn.words(F.col("content"))).alias("n_words"), F.md5("content").alias("h")
    )


# Sentences end at a mark and blanks; an SQL regular expression cannot look behind, so a
# control character is put between them first.
_SENTENCE_CHUNKS_SQL = rf"""
    WITH sentences AS (
      SELECT doc_id, list_filter(str_split(regexp_replace(text, '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS l
      FROM documents),
    units AS (
      SELECT doc_id, flatten(list_transform(l, lambda x:
               CASE WHEN len({words_sql('x')}) <= 100 THEN [{{'s': x, 'n': len({words_sql('x')})}}]
                    ELSE list_transform(range(0, len({words_sql('x')}), 100), lambda i:
                           {{'s': array_to_string(list_slice({words_sql('x')}, i + 1, i + 100), ' '),
                             'n': least(100, len({words_sql('x')}) - i)}}) END)) AS u
      FROM sentences),
    folded AS (
      SELECT doc_id, list_reduce(list_transform(u, lambda x: {{'done': CAST([] AS VARCHAR[]), 'cur': [x]}}),
        lambda a, b: CASE WHEN list_sum(list_transform(a.cur, lambda x: x.n)) + b.cur[1].n <= 100
          THEN {{'done': a.done, 'cur': list_append(a.cur, b.cur[1])}}
          ELSE {{'done': list_append(a.done, array_to_string(list_transform(a.cur, lambda x: x.s), ' ')),
                'cur': list_append(list_filter(
                         list_transform(range(2, len(a.cur) + 2), lambda i: list_slice(a.cur, i, len(a.cur))),
                         lambda t: coalesce(list_sum(list_transform(t, lambda x: x.n)), 0) <= least(10, 100 - b.cur[1].n))[1],
                       b.cur[1])}} END) AS f
      FROM units WHERE len(u) > 0),
    chunks AS (
      SELECT doc_id, list_append(f.done, array_to_string(list_transform(f.cur, lambda x: x.s), ' ')) AS c FROM folded)
    SELECT doc_id, pos, CAST(len({words_sql('content')}) AS INTEGER) AS n_words, md5(content) AS h
    FROM (SELECT doc_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS pos, unnest(c) AS content FROM chunks)"""


@query(_SENTENCE_CHUNKS_SQL)
def chunk_sentences(spark, folder):
    """Whole sentences packed into chunks of 100 words with up to 10 repeated."""
    chunks = chunking.text_chunks(
        documents(spark, folder, "text"), lambda text: text_fn.sentence_chunks(text, max_tokens=100, overlap=10)
    )
    return chunks.select(
        "doc_id", "pos", F.size(text_fn.words(F.col("content"))).alias("n_words"), F.md5("content").alias("h")
    )


@query(
    """SELECT conv_id, count(*) AS n_pages,
              CAST(length(string_agg(text, chr(10) ORDER BY turn)) AS INTEGER) AS n_chars,
              md5(string_agg(text, chr(10) ORDER BY turn)) AS h
       FROM conversations GROUP BY conv_id"""
)
def assemble_pages(spark, folder):
    """Turns as the pages of a document."""
    docs = chunking.assemble_pages(table(spark, folder, "conversations"), "conv_id", "turn", "text")
    return docs.select("conv_id", "n_pages", F.length("text").alias("n_chars"), F.md5("text").alias("h"))
