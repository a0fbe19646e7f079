"""DuckDB SQL for the registered queries, written apart from them: recursive queries against windows and folds, scans against joins."""

from __future__ import annotations

from ..functions.text import LOWER, UPPER
from ..operators.hierarchy import HEADINGS
from ..operators.labels import LABEL_PROMPT
from ..operators.questions import QUESTION_PROMPT
from ..operators.retrieval import CANDIDATE_PROMPT
from . import settings as S

_WORD = r"[\p{{L}}\p{{N}}_]+"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_EST = "(CASE WHEN {0} IS NULL OR length({0}) = 0 THEN 0 ELSE CAST(floor(length({0}) / CAST(2.2 AS DOUBLE)) AS INT) + 1 END)"
_LINES = "list_filter(list_transform(string_split(coalesce({}, ''), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
_WORDS = "list_filter(regexp_split_to_array(coalesce({}, ''), '\\s+'), lambda x: x <> '')"
_TOKENS = "list_distinct(regexp_extract_all(lower(coalesce({}, '')), '" + _WORD + "'))"
_LONG = r"list_distinct(regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_]{{4,}}'))"
_SNIPPET = "CASE WHEN len({w}) <= {n} THEN {t} ELSE array_to_string({w}[1:{n}], ' ') || ' ...' END"

_HEADED = r"""headed AS (
  SELECT doc_id, source, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
    CASE WHEN (i - 1) % 7 = 0 THEN CAST((i - 1) // 7 + 1 AS VARCHAR) || '. Part' || chr(10)
         WHEN (i - 1) % 3 = 1 THEN '1.' || CAST(i - 1 AS VARCHAR) || ' Section' || chr(10) ELSE '' END || x), chr(10)) AS text FROM documents)"""

_TREE = """nodes AS (
  SELECT 'r' || r_regionkey AS id, r_name AS content FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE c_name END FROM customer
  UNION ALL SELECT 'o' || o_orderkey, o_orderpriority FROM orders
), links AS (
  SELECT 'r' || n_regionkey AS parent_id, 'n' || n_nationkey AS child_id, CAST(n_nationkey AS INT) AS order_index FROM nation
  UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, CAST(c_custkey AS INT) FROM customer
  UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, CAST(o_orderkey % 1000 AS INT) FROM orders
)"""

_PATHS = """up AS (
  SELECT id AS leaf_id, id AS node_id, content, 0 AS depth FROM seeds
  UNION ALL
  SELECT u.leaf_id, n.id, n.content, u.depth + 1 FROM up u JOIN links l ON l.child_id = u.node_id JOIN nodes n ON n.id = l.parent_id
), paths AS (
  SELECT leaf_id, list(content ORDER BY depth DESC, node_id) AS path FROM up GROUP BY leaf_id
), crumbs AS (
  SELECT leaf_id, path, path[-1] AS own, array_to_string(list_filter(list_transform(path[1:len(path) - 1], lambda x: trim(x)), lambda x: x <> ''), ' ') AS breadcrumb,
    (SELECT min(order_index) FROM links WHERE child_id = leaf_id) AS order_index FROM paths
)"""

_LEVELS = """lines AS (
  SELECT o_custkey % 50 AS source, o_orderkey AS line_no, CAST(1 + o_custkey % 4 AS INT) AS level, trim(o_orderpriority) || ' ' || CAST(o_orderkey AS VARCHAR) AS line FROM orders
)"""



def _scores(asked: str, chunks: str = "documents") -> str:
    """Scores by a scan of every chunk for every token, as the definition says. asked: a table of item_id and text; chunks: of doc_id and text."""
    return (
        f"chunk AS (SELECT doc_id, lower(text) AS t FROM {chunks}), n AS (SELECT count(*) AS n FROM {chunks}), "
        f"df AS (SELECT token, count(*) AS df FROM (SELECT unnest({_TOKENS.format('text')}) AS token FROM {chunks}) GROUP BY token), "
        f"asked AS (SELECT item_id, unnest({_TOKENS.format('text')}) AS token FROM {asked}), "
        "idf AS (SELECT token, coalesce((SELECT ln((n.n + 1) / CAST(d.df + 1 AS DOUBLE)) + 1 FROM df d, n WHERE d.token = a.token), 1.0) AS w FROM (SELECT DISTINCT token FROM asked) a), "
        "hits AS (SELECT c.doc_id, i.token, (length(c.t) - length(replace(c.t, i.token, ''))) // length(i.token) * i.w AS s FROM chunk c JOIN idf i ON contains(c.t, i.token)), "
        f"phrases AS ({_PHRASES.format(asked)}), "
        "bonus AS (SELECT p.item_id, c.doc_id, 50.0 * count(*) AS s FROM phrases p JOIN chunk c ON contains(c.t, lower(p.phrase)) GROUP BY 1, 2), "
        "scores AS (SELECT item_id, doc_id, round(sum(s), 6) AS score FROM (SELECT a.item_id, h.doc_id, h.s FROM asked a JOIN hits h ON h.token = a.token UNION ALL SELECT item_id, doc_id, s FROM bonus) GROUP BY 1, 2), "
        "ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores WHERE score > 0)"
    )


_PHRASES = (
    r"SELECT item_id, pos, phrase FROM (SELECT item_id, unnest(p) AS phrase, CAST(generate_subscripts(p, 1) - 1 AS INT) AS pos FROM "
    r"(SELECT item_id, list_filter(list_transform(regexp_extract_all(text, '[%U][%L]*(?:\s+[%U][%L]*)+'), lambda x: trim(x)), lambda x: length(x) > 3) AS p FROM {}))"
).replace("%U", UPPER).replace("%L", LOWER)
#: Words 2 to 4 of a text with capitals, as a question.
_NAMED = "'see ' || array_to_string(list_transform(({w})[2:4], lambda x: translate(substring(x, 1, 1), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || lower(substring(x, 2))), ' ')"
_SCORES = _scores("benchmark")

_SHOWN = "chr(10) || 'ID: ' || CAST({i} AS VARCHAR) || chr(10) || chr(10) || 'Content:' || chr(10) || {t} || chr(10) || chr(10) || '------------------------' || chr(10)"

def _related(chunks: str = "documents") -> str:
    return f"""tok AS (SELECT doc_id, source, unnest({_LONG.format('text')}) AS token FROM {chunks}),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM tok a JOIN tok b ON a.token = b.token AND a.source <> b.source GROUP BY 1, 2),
best AS (SELECT a, b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k FROM pairs) WHERE k = 1),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, row_number() OVER (PARTITION BY a.doc_id ORDER BY b.doc_id) AS j FROM {chunks} a JOIN {chunks} b ON a.source = b.source AND a.doc_id <> b.doc_id),
related AS (SELECT a AS doc_id, CAST(row_number() OVER (PARTITION BY a ORDER BY o) AS INT) AS slot, b AS related_id FROM (
  SELECT a, b, CASE WHEN j = 1 THEN 0 ELSE j END AS o FROM same WHERE j <= 2 UNION ALL SELECT a, b, 1 FROM best) QUALIFY slot <= 2)"""


_RELATED = _related()

_GRADED = """graded AS (
  SELECT d.source AS question_id, l.doc_id, l.quality * 2 + l.toxic AS relevance FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  WHERE l.quality * 2 + l.toxic > 0
)"""

_DISTANCE = "round(1 - list_dot_product(CAST(embedding AS DOUBLE[]), q.v) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(q.v, q.v))), 6)"

#: A fold over the lines of a document: {step} gives the new group and the new total.
_FOLD = """WITH RECURSIVE docs AS (SELECT doc_id, %s AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM docs),
fold AS (
  SELECT doc_id, line_no, 0 AS g, %s AS held FROM lines WHERE line_no = 0
  UNION ALL
  SELECT l.doc_id, l.line_no, CASE WHEN %s THEN f.g ELSE f.g + 1 END, CASE WHEN %s THEN %s ELSE %s END
  FROM fold f JOIN lines l ON l.doc_id = f.doc_id AND l.line_no = f.line_no + 1
)
SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(g AS INT) AS %s FROM fold"""


def _fold(first: str, fits: str, more: str, anew: str, name: str) -> str:
    return _FOLD % (_LINES.format("text"), first, fits, fits, more, anew, name)


def _overlap(table: str, key: str, text: str, n: int, out: str, before: str = "", result: str = "f") -> str:
    """The overlap one chunk after the other, by a recursive query that carries the last words."""
    last = lambda t: f"array_to_string(({_WORDS.format(t)})[-{n}:], ' ')"
    over = "CASE WHEN f.tail = '' OR starts_with(c.t, f.tail) THEN c.t ELSE f.tail || chr(10) || c.t END"
    return f"""WITH RECURSIVE {before} c AS (SELECT {key} AS k, {text} AS t, row_number() OVER (ORDER BY {key}) AS i FROM {table}),
f AS (
  SELECT k, i, t, {last('t')} AS tail FROM c WHERE i = 1
  UNION ALL
  SELECT c.k, c.i, {over}, {last(over)} FROM f JOIN c ON c.i = f.i + 1
)
SELECT {out} FROM {result}"""


_BLANK = r"regexp_matches({}, '^\s*$')"
#: A line feed before "<number>. <8 digits> ", where no line begins.
_ROWS_APART = r"regexp_replace({}, '([^\n])(\d+\.\s+\d{{8}}\s+)', '\1' || chr(10) || '\2', 'g')"


def _split(limit: int = 500) -> str:
    """Tables p1 to p5 from a table p0 of k, path (a list of numbers) and t: texts in pieces, cut at one separator after the other.

    Parts are folded one by one; a fold carries the number of its run and how long that is. An empty run (held = 0) takes the next part as it is.
    """
    out = []
    for n, (sep, size) in enumerate((("chr(10) || chr(10)", 2), ("chr(10)", 1), ("'. '", 2), ("' '", 1))):
        longer = f"CASE WHEN f.held > 0 THEN f.held + {size} ELSE 0 END + length(l.part)"
        fits = f"(CASE WHEN {longer} = 0 THEN 0 ELSE floor(({longer}) / CAST(2.2 AS DOUBLE)) + 1 END) <= {limit}"
        alone = f"CASE WHEN length(part) = 0 THEN 0 ELSE floor(length(part) / CAST(2.2 AS DOUBLE)) + 1 END <= {limit}"
        out.append(f"""l{n} AS MATERIALIZED (SELECT k, path, unnest(x) AS part, generate_subscripts(x, 1) - 1 AS i FROM (SELECT k, path, string_split(t, {sep}) AS x FROM p{n} WHERE {_EST.format('t')} > {limit} AND NOT {_BLANK.format('t')})),
f{n} AS (
  SELECT k, path, i, part, 0 AS g, CAST(length(part) AS BIGINT) AS held, part <> '' AS held_part, {alone} AS small FROM l{n} WHERE i = 0
  UNION ALL
  SELECT l.k, l.path, l.i, l.part, CASE WHEN {fits} OR f.held = 0 THEN f.g ELSE f.g + 1 END, CASE WHEN {fits} THEN {longer} ELSE length(l.part) END, l.part <> '' OR (f.held > 0 AND {fits}), true
  FROM f{n} f JOIN l{n} l ON l.k = f.k AND l.path = f.path AND l.i = f.i + 1
),
p{n + 1} AS MATERIALIZED (
  SELECT k, list_append(path, 0) AS path, t FROM p{n} WHERE {_EST.format('t')} <= {limit} AND NOT {_BLANK.format('t')}
  UNION ALL SELECT k, list_append(path, g), string_agg(part, {sep} ORDER BY i) FROM f{n} WHERE held_part GROUP BY k, path, g
)""")
    words = f"SELECT k, path, {_WORDS.format('t')} AS w FROM p4 WHERE {_EST.format('t')} > {limit} AND NOT {_BLANK.format('t')}"
    out.append(f"""p5 AS (
  SELECT k, list_append(path, 0) AS path, t FROM p4 WHERE {_EST.format('t')} <= {limit} AND NOT {_BLANK.format('t')}
  UNION ALL SELECT k, list_append(path, a), array_to_string(w[a + 1:a + {limit}], ' ') FROM (SELECT k, path, w, unnest(range(0, len(w), {limit})) AS a FROM ({words}))
)""")
    return ",\n".join(out)


def _by_headings() -> str:
    """Tables b1 to b4 from a table b0 of k, path, titles and t: bodies below headings, level by level, line by line."""
    out = []
    strip = lambda x: _STRIP.format(x)
    for n, pattern in enumerate(HEADINGS):
        out.append(f"""h{n} AS (
  SELECT k, path, titles, i, line, CAST(regexp_matches(line, '{pattern}') AND NOT {_BLANK.format('line')} AS INT) AS h FROM (SELECT k, path, titles, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM (SELECT k, path, titles, string_split(t, chr(10)) AS x FROM b{n}))
), g{n} AS (SELECT *, sum(h) OVER (PARTITION BY k, path ORDER BY i) AS g, sum(h) OVER (PARTITION BY k, path) AS n FROM h{n}),
b{n + 1} AS MATERIALIZED (
  SELECT k, list_append(path, CAST(g AS BIGINT)) AS path, CASE WHEN g = 0 THEN any_value(titles) ELSE list_append(any_value(titles), max({strip('line')}) FILTER (h = 1)) END AS titles,
    CASE WHEN any_value(n) = 0 THEN string_agg(line, chr(10) ORDER BY i) ELSE {strip("coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (h = 0), '')")} END AS t
  FROM g{n} GROUP BY k, path, g HAVING any_value(n) = 0 OR NOT {_BLANK.format("coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (h = 0), '')")}
)""")
    return ",\n".join(out)


_PIECES = f"p0 AS (SELECT doc_id AS k, CAST([] AS BIGINT[]) AS path, {_ROWS_APART.format('text')} AS t FROM documents),\n{_split()}"
_FIRST = "firsts AS (SELECT doc_id, source, min(doc_id) OVER (PARTITION BY source) AS first FROM documents)"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, **values: str) -> str:
    out = _lit(template)
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return out


def _seed(prompt: str) -> str:
    """What the stand-in model makes of a prompt."""
    return f"CAST('0x' || substring(md5({prompt}), 1, 8) AS BIGINT)"


def _run() -> str:
    """The whole run over the benchmark texts as chunks: prompts, the replies of the stand-in, and what they become."""
    step = "(VALUES (0, 1), (1, -1), (2, 2), (3, -2), (4, 3), (5, -3)) s(step, delta)"
    types, hard = f"{list(S.QUESTION_TYPES)}", f"{list(S.DIFFICULTIES)}"
    return f"""flat AS (SELECT item_id AS doc_id, text, 'in/' || (item_id // 10) AS source, CAST(item_id // 10 AS VARCHAR) AS file_name FROM benchmark), {_related('flat')},
shown AS (SELECT r.doc_id, string_agg('ID: ' || d.doc_id || ' (source: ' || d.source || ')' || chr(10) || 'Content:' || chr(10) || d.text, chr(10) || chr(10) ORDER BY slot) AS x FROM related r JOIN flat d ON d.doc_id = r.related_id GROUP BY 1),
asked_of AS (SELECT f.doc_id, f.text, {_filled(QUESTION_PROMPT, chunk_id="CAST(f.doc_id AS VARCHAR)", chunk="f.text", related_chunks="coalesce(x, '')")} AS p FROM flat f LEFT JOIN shown USING (doc_id)),
replied AS (SELECT doc_id, text, {_seed('p')} AS seed FROM asked_of),
questions AS (SELECT *, type = 'multi-hop' OR difficulty = 'hard' AS deep FROM (SELECT doc_id * 1000 AS item_id, doc_id AS chunk_id, substring(split_part(text, chr(10), 1), 1, 60) AS text, {types}[seed % 3 + 1] AS type, {hard}[seed % 5 % 3 + 1] AS difficulty FROM replied WHERE seed % 17 <> 0)),
{_scores('questions', 'flat')},
filtered AS (SELECT r.item_id, r.doc_id, r.rank FROM ranked r JOIN questions q USING (item_id) WHERE r.rank <= CASE WHEN deep THEN 18 ELSE 15 END),
own AS (SELECT * FROM filtered UNION ALL SELECT * FROM (
  SELECT q.item_id, f.doc_id, CAST(row_number() OVER (PARTITION BY q.item_id ORDER BY f.doc_id) AS INT) AS rank FROM questions q, flat f WHERE q.item_id NOT IN (SELECT item_id FROM filtered) QUALIFY rank <= CASE WHEN q.deep THEN 18 ELSE 15 END)),
tried AS (SELECT o.item_id, n.doc_id, min(o.rank * 10 + s.step) AS found FROM own o JOIN questions q USING (item_id) JOIN flat d ON d.doc_id = o.doc_id, {step} JOIN flat n ON n.doc_id = o.doc_id + s.delta AND n.source = d.source
  WHERE (q.deep OR q.type = 'table') AND NOT EXISTS (SELECT 1 FROM own x WHERE x.item_id = o.item_id AND x.doc_id = n.doc_id) GROUP BY 1, 2),
added AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY found) AS k, (SELECT count(*) FROM own o WHERE o.item_id = t.item_id) AS had FROM tried t),
found AS (SELECT item_id, doc_id, rank FROM own UNION ALL SELECT item_id, doc_id, had + k FROM added WHERE k <= 6 AND had + k <= 18),
listed AS (SELECT item_id, string_agg({_SHOWN.format(i='rank - 1', t='(' + _SNIPPET.format(w='w', n='n', t='t') + ')')}, chr(10) ORDER BY rank) AS x FROM (SELECT f.item_id, f.rank, d.text AS t, {_WORDS.format('d.text')} AS w, CASE WHEN q.deep THEN 300 ELSE 150 END AS n FROM found f JOIN flat d USING (doc_id) JOIN questions q USING (item_id)) GROUP BY 1),
picked AS (SELECT item_id, {_seed('p')} % 19 <> 0 AS ok FROM (SELECT item_id, {_filled(CANDIDATE_PROMPT, question='text', chunks='x', top_k="'5'")} AS p FROM listed JOIN questions USING (item_id))),
chosen AS (SELECT item_id, doc_id, rank - 1 AS k FROM found JOIN picked USING (item_id) WHERE ok AND rank <= 5),
to_grade AS (SELECT item_id, string_agg({_SHOWN.format(i='doc_id', t='f.text')}, chr(10) ORDER BY k) AS x FROM chosen JOIN flat f USING (doc_id) GROUP BY 1),
graded AS (SELECT item_id, {_seed('p')} AS seed FROM (SELECT item_id, {_filled(LABEL_PROMPT, question='text', chunks='x')} AS p FROM to_grade JOIN questions USING (item_id))),
given AS (SELECT item_id, doc_id, (seed + doc_id) % 4 AS relevance, row_number() OVER (PARTITION BY item_id ORDER BY k) - 1 AS pos FROM chosen JOIN graded USING (item_id) WHERE (seed + doc_id) % 4 > 0),
beside AS (SELECT g.item_id, c.doc_id, min([g.pos, c.doc_id - g.doc_id]) AS first FROM given g JOIN questions q USING (item_id) JOIN flat a ON a.doc_id = g.doc_id JOIN chosen c ON c.item_id = g.item_id AND abs(c.doc_id - g.doc_id) IN (1, 2) JOIN flat b ON b.doc_id = c.doc_id AND b.source = a.source
  WHERE q.type = 'table' AND g.relevance >= 2 AND NOT EXISTS (SELECT 1 FROM given x WHERE x.item_id = g.item_id AND x.doc_id = c.doc_id) GROUP BY 1, 2),
labelled AS (SELECT * FROM given UNION ALL SELECT item_id, doc_id, 1, (SELECT max(pos) + 1 FROM given g WHERE g.item_id = b.item_id) + first[1] * 5 + first[2] + 2 FROM beside b),
ordered AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY relevance DESC, pos, doc_id) AS k FROM labelled),
truth AS (SELECT item_id, string_agg(concat_ws(':', doc_id, relevance, f.source, f.file_name, md5({_STRIP.format('substring(f.text, 1, 200)')})), ',' ORDER BY k) AS chunks, 'from ' || string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY k) AS answer, count(*) AS n FROM ordered JOIN flat f USING (doc_id) GROUP BY 1)"""


ORACLES = {
    "token_estimate": f"SELECT doc_id, {_EST.format('text')} AS n_tokens FROM documents",
    "payload_budget": f"SELECT doc_id, {_EST.format('text')} + {_EST.format('source')} + 50 AS payload_tokens, {_EST.format('text')} + {_EST.format('source')} + 50 + 4000 <= 65536 - 1024 AS fits FROM documents",
    "group_pages": "SELECT source, min(doc_id) AS source_ord, CAST(length(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id)) AS INT) AS n_chars, md5(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id)) AS text_md5 FROM documents GROUP BY source",
    "text_to_lines": f"WITH x AS (SELECT doc_id, {_LINES.format('text')} AS l FROM documents) SELECT doc_id, unnest(l) AS line, CAST(generate_subscripts(l, 1) - 1 AS INT) AS line_no FROM x",
    "page_lines": f"WITH x AS (SELECT source, {_LINES.format('s')} AS l FROM (SELECT source, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) AS s FROM documents GROUP BY source)) SELECT source, unnest(l) AS line, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no FROM x",
    "source_file_name": "SELECT page_id, coalesce(nullif(url, ''), 'unknown') AS source, CASE WHEN contains(url, '/') THEN string_split(url, '/')[-1] END AS file_name FROM pages",
    "sequential_ids": "SELECT doc_id, source, row_number() OVER (ORDER BY first_id, doc_id) - 1 AS chunk_id FROM (SELECT doc_id, source, min(doc_id) OVER (PARTITION BY source) AS first_id FROM documents)",
    "table_rows_apart": "SELECT page_id, '1. ' || n || ' Name1 ' || chr(10) || '2. ' || n || ' Name2 ' || chr(10) || '3. ' || n || ' Name3 ' || chr(10) || '12. ' || n || ' Name12 ' AS text FROM (SELECT page_id, lpad(CAST(page_id AS VARCHAR), 8, '0') AS n FROM pages)",
    "proper_noun_phrases": f"WITH b AS (SELECT item_id, {_NAMED.format(w=_WORDS.format('text'))} AS text FROM benchmark) SELECT item_id, pos, phrase FROM ({_PHRASES.format('b')})",
    "phrase_bonus": f"WITH q AS (SELECT doc_id AS item_id, {_NAMED.format(w=_WORDS.format('text'))} AS text FROM documents WHERE doc_id % 100 = 0), {_scores('q')} SELECT item_id, doc_id, score FROM scores WHERE score >= 50",
    "media_blocks": r"""WITH x AS (SELECT page_id, 'intro <img src=''a.png''> of ' || url || '<TABLE border=1>' || chr(10) || '<tr><td><img src=''in''>' || page_id || '</td></tr>' || chr(10) || '</table><IMG x>tail ' || page_id AS t FROM pages),
      y AS (SELECT page_id, regexp_split_to_array(t, '(?is)(?:<table.*?</table>|<img[^>]*>)') AS b, regexp_extract_all(t, '(?is)(<table.*?</table>|<img[^>]*>)') AS m FROM x),
      z AS (SELECT page_id, list_filter(flatten(list_transform(b, lambda v, i: [{'segment': v, 'is_media': false}, {'segment': m[i], 'is_media': true}])), lambda s: s.segment IS NOT NULL AND s.segment <> '') AS s FROM y)
      SELECT page_id, CAST(generate_subscripts(s, 1) - 1 AS INT) AS pos, unnest(s).segment AS segment, unnest(s).is_media AS is_media FROM z""",
    "overlap_tail": _overlap("benchmark", "item_id", "text", 50, "k AS item_id, t AS text"),
    "tla_split": f"WITH RECURSIVE {_PIECES} SELECT k AS doc_id, CAST(row_number() OVER (PARTITION BY k ORDER BY path) - 1 AS INT) AS piece_no, t AS piece FROM p5",
    "split_items": _overlap(
        "chunks", "chunk_id", "t", 50, "chunk_id, source, CAST(NULL AS VARCHAR) AS file_name, CAST(length(f.t) AS INT) AS n_chars, md5(f.t) AS text_md5",
        f"{_PIECES}, {_FIRST}, chunks AS (SELECT row_number() OVER (ORDER BY first, doc_id, path) - 1 AS chunk_id, source, t FROM p5 JOIN firsts ON doc_id = k),", "f JOIN chunks ON chunk_id = k",
    ),
    "hierarchical_split": f"""WITH RECURSIVE {_HEADED}, b0 AS (SELECT doc_id AS k, CAST([] AS BIGINT[]) AS path, CAST([] AS VARCHAR[]) AS titles, text AS t FROM headed), {_by_headings()},
      blocks AS (SELECT row_number() OVER () AS k, k AS doc_id, path AS block, titles, t FROM b4),
      p0 AS (SELECT k, CAST([] AS BIGINT[]) AS path, {_ROWS_APART.format('t')} AS t FROM blocks), {_split()}, {_FIRST},
      x AS (SELECT row_number() OVER (ORDER BY first, b.doc_id, block, p.path) - 1 AS chunk_id, source, array_to_string(titles, ' > ') AS breadcrumb, array_to_string(titles, '|') AS headings, p.t FROM p5 p JOIN blocks b ON b.k = p.k JOIN firsts f ON f.doc_id = b.doc_id)
      SELECT chunk_id, source, breadcrumb, headings, md5(CASE WHEN breadcrumb <> '' THEN '[' || breadcrumb || ']' || chr(10) || t ELSE t END) AS text_md5 FROM x""",
    "budget_fit": f"""WITH RECURSIVE {_SCORES}, own AS (SELECT r.item_id, r.rank, d.text AS t, {_WORDS.format('d.text')} AS w FROM ranked r JOIN documents d ON d.doc_id = r.doc_id WHERE r.rank <= 20),
      sizes AS (SELECT item_id, rank, n_words, length({_SNIPPET.format(w='w', n='n_words', t='t')}) + length({_SHOWN.format(i='rank - 1', t="''")}) AS size FROM own, (VALUES (150), (75), (37), (20)) v(n_words)),
      tries AS (
        SELECT item_id, 0 AS try, count(*) AS n, least(5, count(*)) AS least, 150 AS n_words FROM own GROUP BY 1
        UNION ALL SELECT item_id, try + 1, CASE WHEN n > least THEN n - greatest(1, n // 5) ELSE n END, least, CASE WHEN n > least THEN n_words ELSE greatest(20, n_words // 2) END FROM tries WHERE n > least OR n_words > 20
      ),
      prompts AS (SELECT t.item_id, t.try, t.n, t.n_words, (SELECT length(text) FROM benchmark b WHERE b.item_id = t.item_id) + length('Choose up to 5 chunks that help to answer the question. Reply with JSON only, as in the last line.') + length('Question: ') + length('Chunks:') + 6 + sum(s.size) + t.n - 1 AS n_chars
        FROM tries t JOIN sizes s ON s.item_id = t.item_id AND s.n_words = t.n_words AND s.rank <= t.n GROUP BY t.item_id, t.try, t.n, t.n_words)
      SELECT item_id, CAST(n AS INT) AS n_chunks, CAST(n_words AS INT) AS n_words, CAST(n_chars AS INT) AS n_chars FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY CASE WHEN floor(n_chars / CAST(2.2 AS DOUBLE)) + 1 + 50 <= 3000 THEN try ELSE 1000 - try END) AS k FROM prompts) WHERE k = 1""",
    "documents_overlap": _overlap("documents", "doc_id", "text", 50, "k AS doc_id, CAST(length(t) AS INT) AS n_chars, md5(t) AS text_md5"),
    "heading_depth": f"""WITH RECURSIVE {_LEVELS}, i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY line_no) AS i FROM lines),
      d AS (SELECT source, line_no, level, i, 1 AS depth FROM i WHERE i = 1 UNION ALL SELECT i.source, i.line_no, i.level, i.i, least(i.level, d.depth + 1) FROM d JOIN i ON i.source = d.source AND i.i = d.i + 1)
      SELECT source, line_no, level, CAST(depth AS INT) AS depth FROM d""",
    "section_breadcrumb": f"""WITH RECURSIVE {_LEVELS}, i AS (SELECT source, line_no, line, CASE WHEN line_no % 3 = 0 THEN -1 ELSE level END AS level, row_number() OVER (PARTITION BY source ORDER BY line_no) AS i FROM lines),
      d AS (
        SELECT source, i, line_no, CASE WHEN level = -1 THEN NULL ELSE 1 END AS depth, [CAST(source AS VARCHAR)] AS above, CASE WHEN level = -1 THEN [CAST(source AS VARCHAR)] ELSE [CAST(source AS VARCHAR), trim(line)] END AS open FROM i WHERE i = 1
        UNION ALL
        SELECT i.source, i.i, i.line_no, CASE WHEN i.level <> -1 THEN least(i.level, len(d.open)) END, CASE WHEN i.level = -1 THEN d.open ELSE d.open[1:least(i.level, len(d.open))] END,
          CASE WHEN i.level = -1 THEN d.open ELSE list_append(d.open[1:least(i.level, len(d.open))], trim(i.line)) END
        FROM d JOIN i ON i.source = d.source AND i.i = d.i + 1)
      SELECT source, line_no, CAST(depth AS INT) AS depth, array_to_string(above, ' > ') AS breadcrumb FROM d""",
    "leaf_pack": _fold("length(line)", "floor((f.held + 1 + length(l.line)) / CAST(2.2 AS DOUBLE)) + 1 <= 500", "f.held + 1 + length(l.line)", "length(l.line)", "leaf"),
    "heading_batches": _fold(_EST.format("line"), f"f.held + {_EST.format('l.line')} <= 400", f"f.held + {_EST.format('l.line')}", _EST.format("l.line"), "batch"),
    "rule_headings": f"WITH {_HEADED}, x AS (SELECT doc_id, {_LINES.format('text')} AS l FROM headed), y AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS line_no, unnest(l) AS line FROM x) SELECT * FROM (SELECT doc_id, line_no, CASE "
    + " ".join(f"WHEN regexp_matches(line, '{p}') THEN {k}" for k, p in reversed(list(enumerate(HEADINGS, 1))))
    + " ELSE -1 END AS level FROM y) WHERE level <> -1",
    "docx_tables": """WITH s AS (SELECT s_nationkey AS k, list({'a': s_name, 'b': CAST(s_suppkey AS VARCHAR)} ORDER BY s_suppkey) AS rows FROM supplier GROUP BY 1),
      h AS (SELECT n_name, list_transform(rows, lambda r: '<tr><td>' || r.a || '</td><td>' || r.b || '</td></tr>') AS r FROM s JOIN nation ON n_nationkey = k)
      SELECT n_name AS source, n_name || '|<tab>t0</tab>|<tab>t1</tab>' AS lines, md5('<table>' || array_to_string(r, '') || '</table>') AS t0_md5, '<table>' || r[1] || '</table>' AS t1 FROM h""",
    "ancestors_path": f"WITH RECURSIVE {_TREE}, seeds AS (SELECT * FROM nodes WHERE id LIKE 'o%'), {_PATHS} SELECT leaf_id, array_to_string(path, '/') AS path, breadcrumb, CASE WHEN breadcrumb <> '' THEN '[' || breadcrumb || ']' || chr(10) || own ELSE own END AS text, order_index FROM crumbs",
    "leaf_nodes": f"WITH {_TREE} SELECT id, content FROM nodes WHERE id NOT IN (SELECT parent_id FROM links)",
    "document_listing": "SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS id, source AS bot_id, md5(text) AS name FROM documents WHERE source = 'src3' ORDER BY name, id LIMIT 50",
    "document_half": "SELECT id, name FROM (SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS id, md5(text) AS name, row_number() OVER (ORDER BY md5(text), doc_id) AS k, count(*) OVER () AS n FROM documents) WHERE k <= n // 2",
    "idempotent_append": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN 'held' ELSE c_name END AS c_name, c_nationkey FROM customer",
    "store_links": f"WITH {_TREE} SELECT parent_id, child_id, order_index FROM links WHERE child_id NOT LIKE 'o%'",
    "store_index": f"SELECT 'n' || doc_id AS id, CAST(doc_id AS VARCHAR) AS document_id, source AS bot_id, CAST(len(w) AS INT) AS n_words, md5(array_to_string(list_sort(w), ' ')) AS tsv_md5 FROM (SELECT *, {_TOKENS.format('text')} AS w FROM documents)",
    "stable_ids": "SELECT doc_id, sha256(source || chr(1) || doc_id) AS id FROM documents",
    "token_calibration": f"SELECT count(*) AS n, round(avg(d), 6) AS mean_difference, CAST(max(d) AS INT) AS most_under FROM (SELECT CAST(length(text) // 3 AS INT) - ({_EST.format('text')} + 50) AS d FROM documents)",
    "conditional_tsv": f"SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 5 = 0 THEN 'held' WHEN doc_id % 3 <> 0 THEN array_to_string(list_sort({_TOKENS.format('text')}), ' ') END AS tsv FROM documents",
    "vector_topk": f"WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, label, {_DISTANCE} AS distance FROM embeddings, q ORDER BY distance, vec_id LIMIT 10",
    "vector_topk_filtered": f"WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, label, {_DISTANCE} AS distance FROM embeddings, q WHERE label IN (3, 4, 5) ORDER BY distance, vec_id LIMIT 10",
    "vector_topk_path": f"""WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
      hits AS (SELECT vec_id, 'v' || vec_id AS node_id, label, {_DISTANCE} AS distance FROM embeddings, q ORDER BY distance, node_id LIMIT 5)
      SELECT row_number() OVER (ORDER BY distance, node_id) - 1 AS chunk_id, '[root label ' || label || ']' || chr(10) || 'leaf ' || vec_id AS text, 'name ' || (label % 2) AS source, 'root label ' || label AS breadcrumb, node_id, distance FROM hits""",
    "store_chunks": f"""WITH RECURSIVE {_TREE}, numbered AS (SELECT id, content, CAST(substring(id, 2) AS BIGINT) AS k FROM nodes),
      seeds AS (SELECT id, content FROM numbered WHERE id LIKE 'o%' AND k % 3 IN (1, 2)), {_PATHS}
      SELECT row_number() OVER (ORDER BY CASE d WHEN 2 THEN 0 ELSE 1 END, order_index, path, leaf_id) - 1 AS chunk_id, CASE WHEN breadcrumb <> '' THEN '[' || breadcrumb || ']' || chr(10) || own ELSE own END AS text,
        CASE d WHEN 1 THEN 'First' ELSE 'doc2' END AS source, breadcrumb, leaf_id AS node_id, 'doc' || d AS document_id
      FROM (SELECT *, CAST(substring(leaf_id, 2) AS BIGINT) % 3 AS d FROM crumbs)""",
    "idf_index": f"WITH n AS (SELECT count(*) AS n FROM documents) SELECT token, count(*) AS df, round(ln((any_value(n.n) + 1) / CAST(count(*) + 1 AS DOUBLE)) + 1, 6) AS idf FROM (SELECT unnest({_TOKENS.format('text')}) AS token FROM documents), n GROUP BY token",
    "score_topk": f"WITH {_SCORES} SELECT item_id, doc_id, rank, score FROM ranked WHERE rank <= 100",
    "candidate_limits": "WITH x AS (SELECT item_id, ['one-hop', 'multi-hop', 'table'][item_id % 3 + 1] = 'multi-hop' OR ['easy', 'medium', 'hard'][item_id % 4 % 3 + 1] = 'hard' AS deep FROM benchmark) SELECT item_id, CASE WHEN deep THEN 120 ELSE 100 END AS n, CASE WHEN deep THEN 60 ELSE 40 END AS small FROM x",
    "neighbour_expand": f"""WITH {_SCORES}, own AS (SELECT item_id, doc_id, rank FROM ranked WHERE rank <= 20),
      tried AS (SELECT o.item_id, n.doc_id, min(o.rank * 10 + s.step) AS found FROM own o JOIN documents d ON d.doc_id = o.doc_id,
        (VALUES (0, 1), (1, -1), (2, 2), (3, -2), (4, 3), (5, -3)) s(step, delta) JOIN documents n ON n.doc_id = o.doc_id + s.delta AND n.source = d.source
        WHERE NOT EXISTS (SELECT 1 FROM own x WHERE x.item_id = o.item_id AND x.doc_id = n.doc_id) GROUP BY 1, 2),
      added AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY found) AS k FROM tried)
      SELECT item_id, doc_id, CAST(rank AS INT) AS rank, false AS is_neighbour FROM own UNION ALL SELECT item_id, doc_id, CAST(20 + k AS INT), true FROM added WHERE k <= 4""",
    "snippet": f"WITH x AS (SELECT doc_id, text, {_WORDS.format('text')} AS w FROM documents) SELECT doc_id, md5({_SNIPPET.format(w='w', n=150, t='text')}) AS snippet_md5, {_SNIPPET.format(w='w', n=5, t='text')} AS short FROM x",
    "candidate_prompt": f"""WITH {_SCORES}, x AS (SELECT r.item_id, r.rank, d.text, {_WORDS.format('d.text')} AS w FROM ranked r JOIN documents d ON d.doc_id = r.doc_id WHERE r.rank <= 5),
      b AS (SELECT item_id, string_agg({_SHOWN.format(i='rank - 1', t='(' + _SNIPPET.format(w='w', n=20, t='text') + ')')}, chr(10) ORDER BY rank) AS chunks FROM x GROUP BY 1)
      SELECT item_id, 'Choose up to 5 chunks that help to answer the question. Reply with JSON only, as in the last line.' || chr(10) || chr(10) || 'Question: ' || text || chr(10) || chr(10) || 'Chunks:' || chr(10) || chunks || chr(10) AS prompt FROM b JOIN benchmark USING (item_id)""",
    "map_local_ids": f"WITH {_SCORES}, l AS (SELECT item_id, unnest([item_id % 5, 1, item_id % 3]) AS k, unnest([1, 2, 3]) AS o FROM benchmark), f AS (SELECT item_id, k, min(o) AS o FROM l GROUP BY 1, 2) SELECT f.item_id, CAST(row_number() OVER (PARTITION BY f.item_id ORDER BY f.o) - 1 AS INT) AS pos, r.doc_id FROM f JOIN ranked r ON r.item_id = f.item_id AND r.rank = f.k + 1",
    "related_chunks": f"WITH {_RELATED} SELECT doc_id, slot, related_id FROM related",
    "related_prompt": f"""WITH {_RELATED}, s AS (SELECT r.doc_id, string_agg('ID: ' || d.doc_id || ' (source: ' || d.source || ')' || chr(10) || 'Content:' || chr(10) || d.text, chr(10) || chr(10) ORDER BY slot) AS x FROM related r JOIN documents d ON d.doc_id = r.related_id GROUP BY 1)
      SELECT doc_id, CAST(length(p) AS INT) AS n_chars, md5(p) AS prompt_md5 FROM (SELECT doc_id, doc_id || '|' || text || '|' || coalesce(x, '') AS p FROM documents LEFT JOIN s USING (doc_id))""",
    "question_validation": """WITH b AS (SELECT item_id, text AS question FROM benchmark WHERE item_id % 4 <> 3)
      SELECT item_id, 0 AS item_no, question, 'one-hop' AS type, 'easy' AS difficulty, '7' AS source_chunk_ids FROM b
      UNION ALL SELECT item_id, 1, question, 'multi-hop', 'hard', '7,8,9' FROM b UNION ALL SELECT item_id, 2, question, 'table', 'medium', '8,7' FROM b""",
    "label_parse": "SELECT doc_id, doc_id % 4 = 3 AS failed, CASE WHEN doc_id % 4 = 3 THEN '' WHEN quality * 2 + toxic > 0 THEN doc_id || ':' || (quality * 2 + toxic) || ',5:1' ELSE '5:1' END AS labels FROM labels",
    "table_neighbour_labels": f"""WITH {_GRADED} SELECT question_id, doc_id, relevance FROM graded UNION ALL
      SELECT DISTINCT g.question_id, d.doc_id, 1 FROM graded g JOIN documents a ON a.doc_id = g.doc_id JOIN documents d ON d.source = a.source AND abs(d.doc_id - g.doc_id) IN (1, 2)
      WHERE g.relevance >= 2 AND d.source = g.question_id AND NOT EXISTS (SELECT 1 FROM graded x WHERE x.question_id = g.question_id AND x.doc_id = d.doc_id)""",
    "sorted_labels": f"WITH {_GRADED} SELECT question_id, string_agg(doc_id || ':' || relevance, ',' ORDER BY relevance DESC, doc_id) AS labels FROM graded GROUP BY 1",
    "enrich_labels": f"SELECT l.doc_id * 2 AS chunk_id, l.quality, d.source, CASE WHEN d.doc_id IS NOT NULL THEN d.source END AS file_name, {_STRIP.format('substring(d.text, 1, 200)')} AS text_snippet, CASE WHEN d.doc_id IS NULL THEN 'unknown chunk_id' END AS error FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id * 2",
    "answer_parse": f"""WITH x AS (SELECT conv_id, turn, (conv_id + turn) % 7 AS k, translate(text, '"''' || chr(10) || '{{}}', '') AS x FROM conversations)
      SELECT conv_id, turn, CASE WHEN k = 0 THEN x WHEN k IN (1, 2) AND {_STRIP.format('x')} <> '' THEN {_STRIP.format('x')} WHEN k = 4 AND {_STRIP.format('x')} <> '' THEN {_STRIP.format('x')} WHEN k = 1 THEN 'answer = ''' || x || '''' WHEN k = 2 THEN 'So.' || chr(10) || 'Answer:'
        ELSE 'Not enough information to answer the question.' END AS answer FROM x""",
    "outer_braces": f"""WITH x AS (SELECT conv_id, turn, (conv_id + turn) % 2 = 0 AS braced, text AS s FROM conversations)
      SELECT conv_id, turn, CASE WHEN braced THEN '{{' || s || '{{}}}}' ELSE {_STRIP.format('s')} END AS guarded, CASE WHEN braced THEN '{{' || s || '{{}}}}' ELSE '' END AS bare FROM x""",
    "truncated_json": """WITH r AS (SELECT item_id, substring('{"items": [' || array_to_string(list_transform(range(5), lambda i: '{"id": ' || i || ', "level": 1}'), ', ') || ']}', 1, 20 + CAST(item_id % 130 AS INT)) AS reply FROM benchmark)
      SELECT item_id, CAST(CASE WHEN ends_with(reply, ']}') THEN 5 WHEN closed > 1 THEN closed - 1 ELSE closed END AS INT) AS n_items FROM (SELECT *, length(reply) - length(replace(reply, '}', '')) AS closed FROM r)""",
    "props_json": "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(length(props) AS INT) AS n_chars FROM events",
    "retrieval_dataset": f"WITH {_run()} SELECT item_id AS question_id, text AS question, type, coalesce(chunks, '') AS chunks FROM questions JOIN picked USING (item_id) LEFT JOIN truth USING (item_id) WHERE ok",
    "qa_dataset": f"WITH {_run()} SELECT item_id AS question_id, text AS question, coalesce(answer, '{S.NO_ANSWER}') AS ground_truth_answer, CAST(coalesce(n, 0) AS INT) AS n_chunks FROM questions JOIN picked USING (item_id) LEFT JOIN truth USING (item_id) WHERE ok",
    "failed_items": f"""WITH {_run()} SELECT 'generate_questions' AS stage, doc_id AS chunk_id, CAST(NULL AS VARCHAR) AS question, 'RuntimeError: the stand-in refuses this chunk' AS error FROM replied WHERE seed % 17 = 0
      UNION ALL SELECT 'retrieve/label/answer', NULL, text, 'the reply holds no JSON object' FROM questions JOIN picked USING (item_id) WHERE NOT ok""",
    "failing_model": "SELECT 'generate_questions' AS stage, item_id, sha256(text) AS prompt_hash, 'ValueError: no' AS error FROM benchmark",
}
