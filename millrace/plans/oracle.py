"""DuckDB SQL that gives the same rows as each registered query, over the same tables.

The algorithms differ from the Spark ones where they can: line tables with window functions for code
units, global ranks for the split, a cross product of requests and rules for routing.
"""

from __future__ import annotations

from millrace.operators.formats import EXPLAIN, FIM_MIDDLE, FIM_PREFIX, FIM_SUFFIX, IMPLEMENT, JUDGE_PROMPT, SYSTEM_PROMPT
from millrace.operators.neardup import BANDS, PRIME, ROWS, coefficients
from millrace.plans import views

ORACLE: dict[str, str] = {}


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_UNITS = f"SELECT {_columns(views.UNITS)}, lang FROM documents"
_FILES = f"SELECT {_columns(views.SOURCE_FILES)} FROM documents"


def _draw(key: str, start: int) -> str:
    return f"CAST('0x' || substr(sha256('{views.SEED}|' || {key}), {start}, 8) AS BIGINT)"


def _marked(column: str, markers: tuple[str, ...]) -> str:
    tests = [
        f"(contains({column}, '{m}') AND strlen(substr({column}, 1, strpos({column}, '{m}') - 1)) + {len(m)} <= 512)"
        for m in markers
    ]
    return "(" + " OR ".join(tests) + ")"


_FILE_MARKED = _marked("src", ("DO NOT EDIT", "Code generated"))
_UNIT_MARKED = _marked("body", ("DO NOT EDIT", "Code generated", "go:generate"))
_LONG = "(length(body) - length(replace(body, chr(10), '')) + 1 >= 3)"
_ORDER = "string_split(file_path, '/'), line_number"

# ---- sources

ORACLE["source_catalog"] = """
SELECT 'https://code.example/' || source || '/' || lang AS url,
       CASE WHEN lang = 'de' THEN '/data/' || source ELSE '' END AS dir,
       'src/' AS path,
       CASE lang WHEN 'en' THEN 1.5 WHEN 'fr' THEN 2.0 ELSE 0.0 END::DOUBLE AS weight,
       count(*) AS documents,
       lang = 'de' AS is_local,
       CASE lang WHEN 'en' THEN 1.5 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS effective_weight
FROM documents GROUP BY source, lang"""
ORACLE["scan_code_files"] = "SELECT 'src 1+' AS top, text FROM documents WHERE lang <> 'es'"
ORACLE["select_code_files"] = f"""
SELECT path, src FROM ({_FILES}) WHERE regexp_matches(path, '\\.go$') AND NOT contains('/' || path, '/vendor/')"""
ORACLE["scan_markdown"] = "SELECT 'notes' AS top, text FROM documents"
ORACLE["url_list"] = "SELECT url FROM pages"

_SITEMAPS = """
SELECT page_id, url || '/sitemap.xml' AS url, contains(url, '/fr/') AS broken,
       list_concat([url], list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda h:
           'https://site.example' || h)) AS locs
FROM pages"""
ORACLE["sitemap_urls"] = f"""
WITH maps AS ({_SITEMAPS})
SELECT page_id, CAST(unnest(range(len(locs))) AS BIGINT) AS pos, unnest(locs) AS loc, CAST(NULL AS VARCHAR) AS error
FROM maps WHERE NOT broken
UNION ALL SELECT page_id, 0, NULL, 'sitemap is not well-formed' FROM maps WHERE broken"""

_LINKS = f"""
linked AS (SELECT page_id, url, {views.LINKED_HTML} AS html FROM pages),
hrefs AS (
    SELECT page_id, url, unnest(range(len(h))) AS n,
           replace(trim(unnest(h), '"'''), '&amp;', '&') AS href
    FROM (SELECT page_id, url, regexp_extract_all(html,
            '(?i)<a(?: class=x)?(?: title="[^"]*")? href=("[^"]*"|''[^'']*''|[^\\s>]+)>', 1) AS h FROM linked)),
parts AS (
    SELECT *, regexp_extract(url, '^(https?://[^/]+)', 1) AS origin,
           regexp_extract(url, '^([^?#]*)', 1) AS bare, regexp_extract(url, '^([^#]*)', 1) AS whole FROM hrefs),
resolved AS (
    SELECT page_id, n, origin, CASE
        WHEN href LIKE '//%' OR href LIKE 'mailto:%' THEN NULL
        WHEN href LIKE 'http%' THEN href
        WHEN href LIKE '#%' THEN whole || href
        WHEN href LIKE '?%' THEN bare || href
        WHEN href LIKE '/a/./b/../%' THEN origin || replace(href, '/a/./b/../', '/a/')
        WHEN regexp_matches(href, '[^\\x00-\\x7f]') THEN origin || replace(replace(url_encode(href), '%2F', '/'), '%2C', ',')
        ELSE origin || href END AS link FROM parts),
firsts AS (
    SELECT page_id, link, min(n) AS n FROM resolved WHERE starts_with(link, origin) GROUP BY page_id, link),
links AS (
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS pos, link FROM firsts)"""
ORACLE["discover_links"] = f"WITH {_LINKS} SELECT page_id, pos, link FROM links"

ORACLE["article_dispatch"] = f"""
WITH {_LINKS},
sources AS (SELECT page_id, url, {views.SOURCE_TYPE} AS type FROM pages),
maps AS (SELECT m.*, type FROM ({_SITEMAPS}) m JOIN sources USING (page_id)),
lists AS (
    SELECT page_id, unnest([0, 1]) AS pos,
           unnest([url, CASE WHEN contains(url, '/en/') THEN url ELSE url || '/gone' END]) AS link
    FROM sources WHERE type = 'url_list'),
missing AS (SELECT * FROM lists WHERE link NOT IN (SELECT url FROM pages)),
wanted AS (
    SELECT page_id, 0 AS pos, url AS link FROM sources WHERE type = 'single_page'
    UNION ALL SELECT page_id, pos, link FROM lists WHERE page_id NOT IN (SELECT page_id FROM missing)
    UNION ALL SELECT page_id, pos, link FROM links JOIN sources USING (page_id) WHERE type = 'blog_index'
    UNION ALL SELECT page_id, unnest(range(len(locs))), unnest(locs) FROM maps WHERE type = 'sitemap' AND NOT broken)
SELECT w.page_id AS source_id, CAST(w.pos AS BIGINT) AS pos, w.link AS url, l.html AS content,
       CAST(NULL AS VARCHAR) AS error
FROM wanted w JOIN linked l ON l.url = w.link
UNION ALL SELECT page_id, 0, l.url, html, NULL FROM linked l JOIN sources USING (page_id) WHERE type = 'markdown_repo'
UNION ALL SELECT page_id, 0, NULL, NULL, 'sitemap is not well-formed' FROM maps WHERE type = 'sitemap' AND broken
UNION ALL SELECT page_id, pos, link, NULL, 'no page at ' || link FROM missing
UNION ALL SELECT page_id, 0, url, NULL, 'no such kind of source: feed' FROM sources WHERE type = 'feed'"""

# ---- sampling and formats on documents as units

_SIZE = "length(body)"
_HIGH = f"(({_SIZE} * 3) // 4)"
_LOW = f"({_SIZE} // 4)"
_FIM = f"""
cuts AS (SELECT *, {_LOW} + cut_draw % ({_HIGH} - {_LOW}) AS cut FROM drawn WHERE strlen(body) >= 10),
fim AS (
    SELECT *, '{FIM_PREFIX}' || substr(body, 1, cut) || '{FIM_SUFFIX}' || substr(body, cut + ({_SIZE} - cut) // 2 + 1)
        || '{FIM_MIDDLE}' || substr(body, cut + 1, ({_SIZE} - cut) // 2) AS fim_text FROM cuts)"""


def _drawn(source: str, key: str) -> str:
    return (
        f"drawn AS (SELECT *, {_draw(key, 1)} AS mode_draw, {_draw(key, 9)} AS cut_draw, "
        f"{_draw(key, 17)} AS shuffle_draw FROM ({source}))"
    )


_IS_FIM = f"mode_draw < 0.4::DOUBLE * {2**32}"
_INSTRUCTION = f"""
CASE WHEN doc = '' THEN {_text(IMPLEMENT)} || signature ELSE doc || chr(10) || chr(10) || 'Signature: ' || signature END"""
_FORMATTED = f"""{_FIM},
examples AS (
    SELECT * EXCLUDE (cut, fim_text), fim_text AS text, '' AS instruction, '' AS output, file_path AS source,
           'fim' AS category FROM fim WHERE {_IS_FIM}
    UNION ALL BY NAME
    SELECT *, '' AS text, {_INSTRUCTION} AS instruction, body AS output, file_path AS source,
           'instruction' AS category FROM drawn WHERE NOT ({_IS_FIM}))"""
_EXAMPLES = f"{_drawn(_UNITS, 'doc_id')},{_FORMATTED}"


def _split(source: str, key: str) -> str:
    return f"""
ranked AS (SELECT *, row_number() OVER (ORDER BY shuffle_draw, {key}) AS rank, count(*) OVER () AS n FROM {source}),
labelled AS (
    SELECT * EXCLUDE (rank, n), CASE WHEN rank <= greatest(0, least(n - 1, greatest(1,
        CAST(floor(n * 0.1::DOUBLE) AS BIGINT)))) THEN 'eval' ELSE 'train' END AS split FROM ranked)"""


_RENDERED = """
CASE WHEN text <> '' THEN text ELSE '### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
    || '### Response:' || chr(10) || output END"""

ORACLE["write_jsonl"] = f"""
WITH {_EXAMPLES}
SELECT CASE WHEN category = 'fim' THEN 'text' ELSE 'instruction,output' END || ',source,category' AS fields,
       nullif(text, '') AS text, nullif(instruction, '') AS instruction, nullif(output, '') AS output, source, category
FROM examples"""
ORACLE["read_jsonl"] = f"""
WITH {_EXAMPLES}, {_split('examples', 'doc_id')}
SELECT nullif(text, '') AS text, nullif(instruction, '') AS instruction, nullif(output, '') AS output, source,
       category, split FROM labelled"""
ORACLE["load_prompts"] = """
WITH pieces AS (
    SELECT item_id, unnest(range(len(p))) AS i, unnest(p) AS s FROM
        (SELECT item_id, string_split_regex(text, '\\. ') AS p FROM benchmark))
SELECT 'prompts/' || item_id AS file, i AS position, item_id || '_' || i AS id, 'c' || item_id % 5 AS category,
       '' AS description, s AS prompt,
       CASE WHEN i % 2 = 0 THEN (item_id % 4)::DOUBLE / 4 ELSE i::DOUBLE / 8 END AS weight FROM pieces"""
ORACLE["format_fim"] = f"""
WITH {_drawn(_UNITS, 'doc_id')},{_FIM}
SELECT doc_id, fim_text AS text, file_path AS source, 'fim' AS category FROM fim"""
ORACLE["format_instruction"] = f"""
SELECT doc_id, {_INSTRUCTION} AS instruction, body AS output, file_path AS source, 'instruction' AS category
FROM ({_UNITS})"""
ORACLE["render_training_text"] = f"WITH {_EXAMPLES} SELECT doc_id, {_RENDERED} AS rendered FROM examples"
ORACLE["assign_mode"] = f"""
WITH {_drawn(_UNITS, 'doc_id')}
SELECT doc_id, CASE WHEN {_IS_FIM} THEN 'fim' ELSE 'instruction' END AS mode FROM drawn"""
ORACLE["seeded_shuffle"] = f"SELECT doc_id, {_draw('doc_id', 17)} AS shuffle_draw, text FROM documents"
ORACLE["train_eval_split"] = f"""
WITH {_drawn('SELECT doc_id FROM documents', 'doc_id')}, {_split('drawn', 'doc_id')} SELECT doc_id, split FROM labelled"""


def _stratified(source: str, stratum: str, key: str) -> str:
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY shuffle_draw, {key}) AS rank,
                  count(*) OVER (PARTITION BY {stratum}) AS n FROM {source}),
labelled AS (
    SELECT * EXCLUDE (rank, n), CASE WHEN rank <= greatest(0, least(n - 1, greatest(1,
        CAST(floor(n * 0.1::DOUBLE) AS BIGINT)))) THEN 'eval' ELSE 'train' END AS split FROM ranked)"""


ORACLE["stratified_split"] = f"""
WITH {_drawn('SELECT doc_id, lang FROM documents', 'doc_id')}, {_stratified('drawn', 'lang', 'doc_id')}
SELECT doc_id, lang, split FROM labelled"""
_COPIES = "greatest(1, CAST(ceil((length(origin) % 7) / 2) AS INT))"
ORACLE["oversample"] = f"""
SELECT doc_id, origin, CAST(unnest(range(1, {_COPIES} + 1)) AS INT) AS copy_no
FROM (SELECT doc_id, source AS origin FROM documents)"""
ORACLE["validation_sample"] = f"""
WITH {_EXAMPLES}, {_split('examples', 'doc_id')},
firsts AS (
    SELECT doc_id, {_RENDERED} AS rendered, row_number() OVER (ORDER BY shuffle_draw, doc_id) AS rank
    FROM labelled WHERE split = 'train')
SELECT doc_id, rendered, CASE WHEN rank <= 8 THEN 'train' ELSE 'eval' END AS split FROM firsts WHERE rank <= 10"""
ORACLE["build_counters"] = f"""
WITH {_EXAMPLES}, {_split('examples', 'doc_id')}
SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'eval') AS eval,
       count(*) FILTER (text <> '') AS fim, count(*) FILTER (text = '') AS instr FROM labelled"""

# ---- filters

ORACLE["drop_generated_files"] = f"SELECT path, src FROM ({_FILES}) WHERE NOT {_FILE_MARKED}"
ORACLE["drop_generated_units"] = f"SELECT doc_id, body FROM ({_UNITS}) WHERE NOT {_UNIT_MARKED}"
ORACLE["min_lines"] = f"SELECT doc_id, body FROM ({_UNITS}) WHERE {_LONG}"
_FIRST = f"row_number() OVER (PARTITION BY body ORDER BY {_ORDER}) = 1"
ORACLE["exact_dedup"] = f"SELECT doc_id, file_path, body FROM ({_UNITS}) QUALIFY {_FIRST}"
ORACLE["filter_all"] = f"""
SELECT doc_id, file_path, body FROM ({_UNITS}) WHERE NOT {_UNIT_MARKED} AND {_LONG} QUALIFY {_FIRST}"""



def _near_dedup() -> str:
    minima = ", ".join(f"min(({a} * (h % {PRIME}) + {b}) % {PRIME}) AS m{k}" for k, (a, b) in enumerate(coefficients()))
    bands = ", ".join(f"[{k}, {', '.join(f'm{k * ROWS + r}' for r in range(ROWS))}]" for k in range(BANDS))
    return rf"""
WITH RECURSIVE units AS (
    SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS unit FROM (SELECT * FROM ({_UNITS}) QUALIFY {_FIRST})),
worded AS (SELECT unit, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM units),
shingles AS (
    SELECT unit, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM worded WHERE len(w) > 0),
hashed AS (SELECT DISTINCT unit, CAST('0x' || substr(sha256(s), 1, 15) AS BIGINT) AS h FROM shingles),
sets AS (SELECT unit, list(h) AS hs FROM hashed GROUP BY unit),
signed AS (SELECT unit, {minima} FROM hashed GROUP BY unit),
buckets AS MATERIALIZED (SELECT unit, unnest([{bands}]) AS bucket FROM signed),
pairs AS (SELECT DISTINCT a.unit AS head, b.unit AS unit FROM buckets a JOIN buckets b USING (bucket) WHERE a.unit < b.unit),
near AS MATERIALIZED (
    SELECT head, p.unit FROM pairs p JOIN sets a ON a.unit = head JOIN sets b ON b.unit = p.unit
    WHERE 100 * len(list_intersect(a.hs, b.hs))
        >= 80 * (len(a.hs) + len(b.hs) - len(list_intersect(a.hs, b.hs)))),
rounds AS (
    SELECT bucket, unit, min(unit) OVER (PARTITION BY bucket) AS leader FROM buckets
    UNION ALL
    SELECT bucket, unit, min(unit) OVER (PARTITION BY bucket) FROM (
        SELECT bucket, unit FROM rounds r WHERE unit <> leader
            AND NOT EXISTS (SELECT 1 FROM near p WHERE p.head = r.leader AND p.unit = r.unit))),
links AS MATERIALIZED (SELECT DISTINCT leader AS a, r.unit AS b FROM rounds r JOIN near p ON p.head = r.leader AND p.unit = r.unit),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT DISTINCT a AS unit, a AS other FROM ends UNION SELECT unit, b FROM reached JOIN ends ON a = other)
SELECT doc_id, file_path, body FROM units
WHERE unit NOT IN (SELECT unit FROM reached GROUP BY unit HAVING min(other) < unit)"""


ORACLE["near_dedup"] = _near_dedup()

# ---- code units

_TOKENS = r"""(?s)`[^`]*`|/\*.*?\*/|//[^\n]*|"(?:[^"\\\n]|\\.)*"|''(?:[^''\\\n]|\\.)*''"""
_IMPORT = r"""["`]([^"`\n]+)["`]"""


def _units_of(files: str) -> str:
    return f"""
files AS ({files}),
tokens AS (
    SELECT path, string_split_regex(src, '{_TOKENS}') AS b, regexp_extract_all(src, '{_TOKENS}') AS t FROM files),
folded AS (
    SELECT path, array_to_string(list_transform(b, lambda s, i:
        s || coalesce(replace(t[i], chr(10), chr(2)), '')), '') AS src FROM tokens),
heads AS (
    SELECT path, regexp_extract(src, '(?m)^package[ \\t]+([^\\s;/]+)', 1) AS package,
        regexp_extract_all(regexp_replace(regexp_extract(src, '(?s)^(.*?)\\n(?:func|var|const|type)\\b', 1),
            '//[^\\n]*', '', 'g'), '{_IMPORT}', 1) AS imports FROM folded),
brackets AS (
    SELECT path, unnest(x) AS c, unnest(range(len(x))) AS i
    FROM (SELECT path, regexp_extract_all(array_to_string(b, ' '), '[(){{}}\\[\\]]') AS x FROM tokens)),
levels AS (
    SELECT path, c, i, c IN (')', ']', '}}') AS closes, sum(CASE WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY path ORDER BY i)
        + CASE WHEN closes THEN 1 ELSE 0 END AS level FROM brackets),
couples AS (
    SELECT path, level, c || coalesce(lead(c) OVER same, '') AS couple, row_number() OVER same AS k
    FROM levels WINDOW same AS (PARTITION BY path, level ORDER BY i)),
unbalanced AS (SELECT path FROM couples WHERE level < 1 OR (k % 2 = 1 AND couple NOT IN ('()', '[]', '{{}}'))),
lines AS (
    SELECT path, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS ln
    FROM (SELECT path, string_split(src, chr(10)) AS l FROM folded)),
flagged AS (
    SELECT *, starts_with(line, 'func ') AS is_func, regexp_matches(line, '^(//|/\\*.*\\*/\\s*$)') AS is_note,
        regexp_matches(line, '^\\}}') AS is_close FROM lines),
numbered AS (
    SELECT *, max(CASE WHEN is_func THEN ln END) OVER (PARTITION BY path ORDER BY ln) AS start,
        coalesce(max(CASE WHEN NOT is_note THEN ln END) OVER (PARTITION BY path ORDER BY ln
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS last_code,
        ln + coalesce(sum(length(line) - length(replace(line, chr(2), ''))) OVER (PARTITION BY path ORDER BY ln
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS true_ln FROM flagged),
starts AS (SELECT path, ln AS line_number, true_ln, last_code, regexp_replace(line, '[ \\t]*//[^"]*$', '') AS head
    FROM numbered WHERE is_func),
ends AS (
    SELECT s.path, s.line_number, s.true_ln, s.last_code, CASE WHEN regexp_matches(s.head, '[{{(,]$')
        THEN (SELECT min(n.ln) FROM numbered n WHERE n.path = s.path AND n.start = s.line_number AND n.is_close)
        ELSE s.line_number END AS last_line FROM starts s),
texts AS (
    SELECT e.path, CAST(e.true_ln AS BIGINT) AS line_number,
        string_agg(l.line, chr(10) ORDER BY l.ln) FILTER (l.ln >= e.line_number) AS declaration,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.ln) FILTER (l.ln < e.line_number), '') AS note
    FROM ends e JOIN lines l ON l.path = e.path AND l.ln > e.last_code AND l.ln <= e.last_line
    GROUP BY e.path, e.line_number, e.true_ln),
found AS (
    SELECT h.package, h.imports, t.path AS file_path, t.line_number,
        replace(CASE WHEN note = '' THEN '' ELSE note || chr(10) END || declaration, chr(2), chr(10)) AS body,
        regexp_replace(split_part(declaration, chr(10), 1), ' \\{{( //.*)?$', '') AS signature,
        regexp_extract(declaration, '^func (?:\\([^)]*\\) )?(\\w+)', 1) AS name,
        regexp_extract(declaration, '^func \\((?:\\w+ )?([^)]+)\\)', 1) AS receiver,
        trim(replace(regexp_replace(regexp_replace(regexp_replace(replace(note, '*/', ''), '(?m)^//go:.*\\n?', '', 'g'),
            '(?m)^(// ?|/\\*)', '', 'g'), '(?m) +$', '', 'g'), chr(2), chr(10)), ' ' || chr(10)) AS doc
    FROM texts t JOIN heads h USING (path) WHERE h.package <> '' AND path NOT IN (SELECT path FROM unbalanced))"""


_SOURCE_UNITS = _units_of(_FILES)
ORACLE["code_units"] = f"""
WITH {_SOURCE_UNITS}
SELECT package, name, receiver, body, array_to_string(imports, ',') AS imports, file_path, line_number FROM found"""
ORACLE["unit_signature"] = f"""
WITH {_SOURCE_UNITS}
SELECT file_path, line_number, signature FROM found"""
ORACLE["unit_doc"] = f"WITH {_SOURCE_UNITS} SELECT file_path, line_number, doc FROM found"

_CODE = f"""
SELECT path, src FROM ({_FILES})
WHERE regexp_matches(path, '\\.go$') AND NOT contains('/' || path, '/vendor/') AND NOT {_FILE_MARKED}"""
_KEPT = f"SELECT * FROM found WHERE NOT {_UNIT_MARKED} AND {_LONG} QUALIFY {_FIRST}"
ORACLE["build_dataset"] = f"""
WITH {_units_of(_CODE)},
kept AS ({_KEPT}), {_drawn('SELECT * FROM kept', "file_path || '|' || line_number")},{_FORMATTED},
{_split('examples', 'source, line_number')}
SELECT text, instruction, output, source, category, line_number, split FROM labelled"""

# ---- pages

_STEPS = (
    (r"(?s)<!--.*?-->", "''"),
    (r"(?is)<(?:script|style|title)\b.*?</(?:script|style|title)>", "''"),
    (r"""(?i)<h[123](?:\s(?:[^>"]|"[^"]*")*)?>""", "chr(1) || 'H'"),
    (r"(?i)<pre(?:\s[^>]*)?>", "chr(1) || 'C'"),
    (r"""(?i)<p(?:\s(?:[^>"]|"[^"]*")*)?>""", "chr(1) || 'P'"),
    (r"(?i)</?(?:nav|ul|ol|li|div|article|footer|header|section|h[1-6]|pre|p)(?:\s[^>]*)?>", "chr(1) || 'X'"),
    (r"(?s)<[a-zA-Z/!][^>]*(?:>|\z)", "''"),
)


def _marked_html() -> str:
    text = views.ARTICLE_HTML
    for pattern, marker in _STEPS:
        text = f"regexp_replace({text}, '{pattern}', {marker}, 'g')"
    for name, plain in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{plain}')"
    return text


_SECTIONS = f"""
parts AS (
    SELECT page_id, unnest(range(len(s))) AS n, unnest(s) AS part
    FROM (SELECT page_id, string_split({_marked_html()}, chr(1) || 'H') AS s FROM pages)),
pieces AS (
    SELECT page_id, n, CASE WHEN n = 0 THEN '' ELSE string_split(part, chr(1))[1] END AS title,
        string_split(part, chr(1))[2:] AS t FROM parts),
texts AS (
    SELECT page_id, n, title,
        list_filter(list_transform(list_filter(t, lambda x: x[1] = 'P'), lambda x: trim(x[2:], {_text(" ")} || chr(10) || chr(9) || chr(13) || chr(160))), lambda x: x <> '') AS p,
        list_filter(list_transform(list_filter(t, lambda x: x[1] = 'C'), lambda x: trim(x[2:], {_text(" ")} || chr(10) || chr(9) || chr(13) || chr(160))), lambda x: x <> '') AS c
    FROM pieces),
sections AS (
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS section_no, title,
        array_to_string(p, chr(10)) AS prose, c AS code_blocks FROM texts WHERE len(p) > 0 OR len(c) > 0)"""
ORACLE["prose_sections"] = f"""
WITH {_SECTIONS}
SELECT page_id, section_no, title, prose, array_to_string(code_blocks, chr(30)) AS code_blocks FROM sections"""
ORACLE["prose_pairs"] = f"""
WITH {_SECTIONS},
blocks AS (
    SELECT page_id, section_no, unnest(range(len(code_blocks))) AS block_no, prose, unnest(code_blocks) AS code
    FROM sections)
SELECT page_id, section_no, block_no, prose AS instruction, code AS output, 'prose_to_code' AS category FROM blocks
UNION ALL
SELECT page_id, section_no, block_no, {_text(EXPLAIN)} || code, prose, 'code_to_prose' FROM blocks"""

# ---- prompts and answers

_BEFORE, _BETWEEN, _AFTER = JUDGE_PROMPT.split("%s")
ORACLE["judge_prompt"] = f"""
SELECT a.conv_id, a.turn, {_text(_BEFORE)} || a.text || {_text(_BETWEEN)} || b.text || {_text(_AFTER)} AS judge_prompt
FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1"""
ORACLE["chat_request"] = f"""
SELECT conv_id, turn, CAST(json_object('model', 'code-tuned', 'messages', json_array(
    json_object('role', 'system', 'content', {_text(SYSTEM_PROMPT)}),
    json_object('role', 'user', 'content', text))) AS VARCHAR) AS request FROM conversations"""
ORACLE["parse_chat_response"] = """
WITH answers AS (
    SELECT conv_id, turn, role, text, turn > 5 AS failed, CASE role
        WHEN 'assistant' THEN CAST(json_object('choices', json_array(json_object('message',
            json_object('role', role, 'content', text)))) AS VARCHAR)
        WHEN 'user' THEN '{"choices": []}' ELSE 'busy' END AS body FROM conversations)
SELECT conv_id, turn, CASE WHEN NOT failed AND role = 'assistant' THEN text END AS content,
    CASE WHEN failed THEN 'answer with status 500: ' || body WHEN role = 'user' THEN 'answer has no choice'
        WHEN role <> 'assistant' THEN 'answer is not readable' END AS error FROM answers"""

# ---- evaluation

_SCORE = "(CASE WHEN compiles THEN 0.4::DOUBLE ELSE 0::DOUBLE END + CASE WHEN vet_clean THEN 0.3::DOUBLE ELSE 0::DOUBLE END)"
_RESULTS = """
SELECT d.doc_id::VARCHAR AS prompt_id, d.doc_id AS position, lang AS category, quality = 1 AS compiles,
    toxic = 0 AS vet_clean, n_chars > 500 AS long FROM documents d JOIN labels USING (doc_id)"""
ORACLE["score_results"] = f"SELECT prompt_id, category, {_SCORE} AS score FROM ({_RESULTS})"
ORACLE["eval_summary"] = f"""
SELECT category, count(*) AS total_prompts, round(avg({_SCORE}), 9) AS avg_score,
    round(avg(compiles::INT), 9) AS compile_rate, round(avg(vet_clean::INT), 9) AS vet_rate
FROM ({_RESULTS}) GROUP BY category"""
_RUNS = f"""
results AS ({_RESULTS}),
baseline AS (
    SELECT prompt_id, position, {_SCORE} AS score FROM (
        SELECT * FROM results UNION ALL BY NAME
        SELECT * REPLACE (NOT vet_clean AS vet_clean, position + 1000000000 AS position) FROM results WHERE category = 'fr')),
candidate AS (
    SELECT prompt_id, position, {_SCORE} AS score FROM (
        SELECT * REPLACE (long AS vet_clean) FROM results UNION ALL BY NAME
        SELECT * REPLACE (long AS vet_clean, position + 1000000000 AS position) FROM results WHERE category = 'de')),
verdicts AS (
    SELECT c.prompt_id, c.position, c.score, b.score AS baseline_score, CASE WHEN c.score > b.score + 0.05::DOUBLE
        THEN 'improved' WHEN c.score < b.score - 0.05::DOUBLE THEN 'regressed' ELSE 'unchanged' END AS verdict
    FROM candidate c JOIN (SELECT * FROM baseline
        QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY position DESC) = 1) b USING (prompt_id))"""
ORACLE["eval_compare"] = f"WITH {_RUNS} SELECT * FROM verdicts"
ORACLE["eval_compare_summary"] = f"""
WITH {_RUNS}
SELECT round((SELECT avg(score) FROM candidate) - (SELECT avg(score) FROM baseline), 9) AS score_delta,
    count(*) FILTER (verdict = 'improved') AS improved, count(*) FILTER (verdict = 'regressed') AS regressed,
    count(*) FILTER (verdict = 'unchanged') AS unchanged FROM verdicts"""

_CRITERIA = ("correctness", "idiom", "simplicity", "completeness")
_JUDGED = f"""
judged AS (SELECT doc_id, quality, {views.JUDGE_RESPONSE} AS r FROM labels),
checked AS (
    SELECT doc_id, quality, CASE WHEN json_valid(r) THEN r ELSE '{{}}' END AS j, json_valid(r) AND {' AND '.join(
        f"coalesce(json_type(CASE WHEN json_valid(r) THEN r END, '$.{c}') IN ('UBIGINT', 'BIGINT', 'NULL'), true)"
        for c in _CRITERIA)} AS ok FROM judged),
parsed AS (
    SELECT doc_id, quality, ok, {', '.join(
        f"CASE WHEN ok THEN coalesce(CAST(json_extract_string(j, '$.{c}') AS BIGINT), 0) END AS {c}"
        for c in _CRITERIA)} FROM checked)"""
ORACLE["parse_judge"] = f"""
WITH {_JUDGED} SELECT doc_id, ok, {', '.join(f'coalesce({c}, -1) AS {c}' for c in _CRITERIA)} FROM parsed"""
ORACLE["judge_average"] = f"""
WITH {_JUDGED}
SELECT quality, count(*) AS n, round(avg((correctness + idiom + simplicity + completeness) / 4.0::DOUBLE), 9) AS judge_avg
FROM parsed WHERE ok GROUP BY quality"""

ORACLE["weighted_score"] = f"""
WITH means AS (SELECT category, avg({_SCORE}) AS mean FROM ({_RESULTS}) GROUP BY category),
weights AS (SELECT lang AS category, count(*)::DOUBLE AS weight FROM documents GROUP BY lang)
SELECT count(*) AS categories, round(sum(weight * mean) / sum(weight), 9) AS weighted_score FROM means JOIN weights USING (category)"""
ORACLE["judge_agreement"] = f"""
WITH {_JUDGED}
SELECT count(*) AS judged,
       round(corr({_SCORE}, (correctness + idiom + simplicity + completeness) / 4.0::DOUBLE), 6) AS agreement
FROM ({_RESULTS}) r JOIN parsed p ON p.doc_id = r.position WHERE ok"""

# ---- routing

_RULES = ", ".join(
    f"({i}, '{r.path}', '{r.model}', {str(r.default).lower()}, '{r.target}')" for i, r in enumerate(views.ROUTES)
)
_ALIASES = ", ".join(f"('{a}', '{m}')" for a, m in views.ALIASES.items())
_MATCH = """CASE WHEN u.path <> '' THEN starts_with(r.path, u.path)
    WHEN u.model LIKE '%*' THEN starts_with(r.requested, rtrim(u.model, '*'))
    WHEN u.model <> '' THEN r.requested = u.model ELSE u.is_default END"""


def _routed(requests: str) -> str:
    return f"""
rules(rule_no, path, model, is_default, target) AS (VALUES {_RULES}),
aliases(alias, model) AS (VALUES {_ALIASES}),
requests AS ({requests}),
chosen AS (
    SELECT r.event_id, r.requested, min_by(u.target, u.rule_no) AS target, count(u.rule_no) AS n
    FROM requests r LEFT JOIN rules u ON {_MATCH} GROUP BY r.event_id, r.requested),
routed AS (
    SELECT c.event_id, CASE WHEN n = 0 THEN requested ELSE coalesce(a.model, '') END AS resolved
    FROM chosen c LEFT JOIN aliases a ON a.alias = c.target)"""


_REQUESTS = f"SELECT {_columns(views.REQUESTS)} FROM events"
ORACLE["route_requests"] = f"WITH {_routed(_REQUESTS)} SELECT event_id, resolved FROM routed"
ORACLE["route_requests_by_table"] = f"""
WITH rules AS (
    SELECT DISTINCT user_id AS rule_no, '' AS path, 'team-' || user_id || '*' AS model, 'u' || user_id % 10 AS target
    FROM events
    UNION ALL SELECT DISTINCT -length(event_type), CASE WHEN event_type = 'error' THEN '/fill' ELSE '' END,
        CASE WHEN event_type = 'view' THEN 'thinker' WHEN event_type = 'signup' THEN 'draft*' ELSE '-' END, event_type
    FROM events),
aliases AS (
    SELECT DISTINCT 'u' || user_id % 10 AS alias, 'served-' || user_id % 10 AS model FROM events
    UNION ALL SELECT DISTINCT event_type, upper(event_type) FROM events WHERE event_type <> 'view'),
requests AS ({_REQUESTS}),
pairs AS (SELECT DISTINCT requested, path FROM requests),
chosen AS (
    SELECT r.requested, r.path, min_by(u.target, u.rule_no) AS target, count(u.rule_no) AS n
    FROM pairs r LEFT JOIN rules u ON {_MATCH.replace(' ELSE u.is_default', ' ELSE false')} GROUP BY r.requested, r.path)
SELECT r.event_id, CASE WHEN n = 0 THEN r.requested ELSE coalesce(a.model, '') END AS resolved
FROM requests r JOIN chosen c USING (requested, path) LEFT JOIN aliases a ON a.alias = c.target"""

_LOGGED = f"""
WITH {_routed("SELECT event_id, path, json_extract_string(body, '$.model') AS requested FROM (" + _REQUESTS + ") "
              "WHERE CASE WHEN json_valid(body) THEN json_type(body, '$.model') = 'VARCHAR' ELSE false END")},
logged AS (
    SELECT q.event_id, coalesce(r.resolved, '') AS model, q.is_err
    FROM ({_REQUESTS}) q LEFT JOIN routed r USING (event_id))"""
ORACLE["route_log_model"] = f"{_LOGGED} SELECT event_id, model FROM logged"
ORACLE["request_metrics"] = f"""
{_LOGGED} SELECT model, count(*) AS requests, count(*) FILTER (is_err) AS errors FROM logged GROUP BY model"""
ORACLE["request_metrics_stream"] = ORACLE["request_metrics"]

# ---- all sources in one dataset

ORACLE["min_file_lines"] = f"SELECT path, src FROM ({_FILES}) WHERE length(src) - length(replace(src, chr(10), '')) + 1 >= 40"
_ALL = f"""
SELECT 'code-' || doc_id AS example_id, 'code-' || doc_id AS group_id, split_part(source, '/', 1) AS origin, category, text,
       instruction, output
FROM (WITH {_EXAMPLES} SELECT * FROM examples)
UNION ALL
SELECT category || '-' || page_id || '-' || section_no || '-' || block_no, page_id || '-' || section_no || '-' || block_no,
       'articles', category, '', instruction, output
FROM ({ORACLE['prose_pairs']})"""


def _merged(examples: str) -> str:
    """Groups are ranked in their kind of example, rows follow their group."""
    return f"""
WITH every AS ({examples}),
kinds AS (SELECT *, CASE WHEN category IN ('fim', 'instruction') THEN category ELSE 'pair' END AS kind FROM every),
drawn AS (SELECT DISTINCT kind, group_id, {_draw('group_id', 17)} AS shuffle_draw FROM kinds),
{_stratified('drawn', 'kind', 'group_id')},
sided AS (SELECT k.*, l.split FROM kinds k JOIN labelled l USING (kind, group_id))
SELECT example_id, group_id, origin, category, split, text, instruction, output, CAST(unnest(range(1, 1 +
    CASE WHEN split = 'eval' OR kind = 'pair' THEN 1 ELSE {_COPIES} END)) AS INT) AS copy_no FROM sided"""


ORACLE["merge_sources"] = f"SELECT * EXCLUDE (group_id) FROM ({_merged(_ALL)})"
_BUILT = f"""
SELECT sha256('{views.SEED}|code|' || sha256(body)) AS example_id, example_id AS group_id, split_part(source, '/', 1) AS origin,
       category, text, instruction, output
FROM (WITH {_units_of(_CODE)},
kept AS ({_KEPT}), {_drawn('SELECT * FROM kept', "file_path || '|' || line_number")},{_FORMATTED} SELECT * FROM examples)
UNION ALL
SELECT sha256('{views.SEED}|' || category || '|' || page_id || '|0|' || url || '|' || section_no || '|' || block_no),
       sha256('{views.SEED}|' || CASE category WHEN 'prose_to_code' THEN sha256(instruction) || '|' || sha256(output)
           ELSE sha256(output) || '|' || sha256(substr(instruction, {len(EXPLAIN) + 1})) END),
       url, category, '', instruction, output
FROM ({ORACLE['prose_pairs']}) JOIN pages USING (page_id)"""
ORACLE["build_from_sources"] = _merged(_BUILT)
