"""DuckDB SQL giving the same rows as the registered queries."""

from __future__ import annotations

from .specs import (
    ASKED,
    BATCH,
    LANGS,
    MIXED_COLS,
    N_SIGNIFICANT,
    N_SLOTS,
    PAGE_FROM,
    PAGE_SIZE,
    SEED,
    STOP_WORDS,
    WORDS,
)

WORD = r"[\p{L}\p{N}_]+"
ENGLISH = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()
# Word breaks of scripts with letters and blanks: the same rules without Han, Kana, Thai and the like.
_LETTERS = r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Armenian}\p{Arabic}\p{Hangul}][\p{Latin}\p{Greek}\p{Cyrillic}\p{Armenian}\p{Arabic}\p{Hangul}\p{M}\p{Cf}]*"
_DIGITS = r"\p{Nd}[\p{Nd}\p{M}\p{Cf}]*"
_BOTH = "[.‘’․﹒＇''"
_WORDED = rf"{_LETTERS}(?:{_BOTH}:·‧︓﹕：]{_LETTERS})*"
_NUMBER = rf"{_DIGITS}(?:{_BOTH},;،⁄︐︔﹐﹔，；]{_DIGITS})*"
_PART = rf"(?:{_WORDED}|{_NUMBER})+"
_URL = r'(?:https?|ftp|file)://[^\s<>"]*[^\s<>".,;:!?)\]'']'
_EMAIL = r"[\p{L}\p{N}._%+-]+@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,63}"
WORD_BREAK = rf"{_URL}|{_EMAIL}|(?:\p{{Pc}}+)?{_PART}(?:\p{{Pc}}+{_PART})*(?:\p{{Pc}}+)?"
URL_EMAIL = r"https?://[^\s]+|[^\s@]+@[^\s@]+\.[\p{L}]+|[\p{L}\p{N}_]+"
TEST_EDGE = f"{int(0.33 * 0x10000):04x}"
LABELLED = "(SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id))"


def text(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(text(w) for w in words)


def found(expression: str, pattern: str = WORD) -> str:
    return f"regexp_extract_all({expression}, '{pattern}')"


TOKENS = found("lower(text)")


def words(terms, first: int = 0) -> str:
    rows = ", ".join(f"({text(t)}, {first + i})" for i, t in enumerate(terms))
    return f"(SELECT * FROM (VALUES {rows}) v(term, col))"


def base(source: str = "documents", keys: str = "doc_id") -> str:
    """tf: term frequencies; st: statistics of the terms."""
    return f"""tok AS (SELECT {keys}, unnest({TOKENS}) AS term FROM {source}),
tf AS (SELECT {keys}, term, count(*) AS tf FROM tok GROUP BY ALL),
st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM tf GROUP BY ALL)"""


def cells(value: str, terms=WORDS, key: str = "doc_id", where: str = "") -> str:
    return (
        f"SELECT {key}, CAST(col AS INTEGER) AS col, CAST({value} AS DOUBLE) AS data "
        f"FROM tf JOIN {words(terms)} voc USING (term) JOIN st USING (term) {where}"
    )


def positions(tokens: str) -> str:
    return f"""WITH t AS (SELECT doc_id, {tokens} AS toks FROM documents)
SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token FROM t"""


def number(name: str, col: int, source: str, key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, CAST({col} AS INTEGER) AS col, CAST({name} AS DOUBLE) AS data "
        f"FROM {source} WHERE {name} <> 0"
    )


def chosen(source: str, name: str, values, first: int, value: str = "1.0") -> str:
    return (
        f"SELECT doc_id, CAST(col AS INTEGER) AS col, CAST({value} AS DOUBLE) AS data "
        f"FROM {source} JOIN {words(values, first)} k ON {name} = k.term"
    )


N = len(WORDS)
MIXED = f"""WITH docs AS {LABELLED},
{base("docs")},
cell AS ({cells("tf.tf")}
  UNION ALL {chosen("docs", "lang", LANGS, N)}
  UNION ALL {number("n_chars", N + len(LANGS), "docs")}
  UNION ALL {number("toxic", N + len(LANGS) + 1, "docs")})"""
JSON = (
    "'{' || coalesce(string_agg('\"' || col || '\":' || CAST(data AS VARCHAR), ',' ORDER BY col), '') || '}'"
)
TF = f"WITH {base()}, cell AS ({cells('tf.tf')})"


def as_json(with_cells: str, docs: str = "docs", columns: str = "doc_id", key: str = "doc_id") -> str:
    group = ", ".join(str(i + 1) for i in range(len(columns.split(","))))
    return (
        f"{with_cells} SELECT {columns}, {JSON} AS matrix FROM {docs} LEFT JOIN cell USING ({key}) "
        f"GROUP BY {group}"
    )


def having(predicate: str, source: str = "documents") -> str:
    return f"SELECT doc_id FROM {source} WHERE {predicate}"


def some_token(test: str) -> str:
    return (
        f"WITH tok AS (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) "
        f"SELECT DISTINCT doc_id FROM tok WHERE {test}"
    )


SCROLLED = f"""WITH {base()},
r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS row FROM documents),
cell AS ({cells("tf.tf")}),
b AS (SELECT doc_id, CAST(row // {BATCH} AS BIGINT) AS batch_id, CAST(row % {BATCH} AS BIGINT) AS brow, row FROM r)"""


def significant(source: str, classes: str, inside: str, size: int) -> str:
    """Per class: counts, sizes, score, rank."""
    return f"""WITH docs AS {source},
dt AS (SELECT DISTINCT doc_id, {classes} AS class, unnest({TOKENS}) AS key FROM docs),
bg AS (SELECT key, count(*) AS bg_count FROM dt GROUP BY ALL),
fg AS (SELECT class, key, count(*) AS doc_count FROM dt {inside} GROUP BY ALL HAVING count(*) >= 3),
sz AS (SELECT {classes} AS class, count(*) AS fg_size FROM docs GROUP BY ALL),
n AS (SELECT count(*) AS bg_size FROM docs),
sc AS (SELECT class, key, doc_count, bg_count,
  CAST(doc_count AS DOUBLE) / CAST(fg_size AS DOUBLE) AS f,
  CAST(bg_count AS DOUBLE) / CAST(bg_size AS DOUBLE) AS b
  FROM fg JOIN bg USING (key) JOIN sz USING (class), n),
ranked AS (SELECT class, CAST(row_number() OVER (PARTITION BY class ORDER BY (f - b) * (f / b) DESC, key) AS INTEGER) AS rank,
  key, doc_count, (f - b) * (f / b) AS score, bg_count FROM sc WHERE f > b),
best AS (SELECT * FROM ranked WHERE rank <= {size})"""


BY_CLASS = significant(LABELLED, "toxic", "", N_SIGNIFICANT)
UNION = """, placed AS (SELECT key, min((class * 1000000) + rank) AS place FROM best GROUP BY key)
SELECT key AS term, CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS col FROM placed"""


def oracle_sql() -> dict[str, str]:
    sql = {}
    # text analysis and statistics
    sql["analyze_tokens"] = positions(TOKENS)
    kept = f"list_filter({found('text')}, lambda t: t NOT IN ({listed(STOP_WORDS)}))"
    sql["analyze_stop_list"] = positions(f"list_transform({kept}, lambda t: lower(t))")
    broken = found("text", WORD_BREAK)
    lost = f"length(t) > 255 OR t IN ({listed(ENGLISH)})"
    sql["analyze_word_break"] = positions(
        f"list_transform(list_filter({broken}, lambda t: NOT ({lost})), lambda t: lower(t))"
    )
    slots = positions(f"list_transform({broken}, lambda t: CASE WHEN {lost} THEN NULL ELSE lower(t) END)")
    sql["analyze_word_slots"] = f"SELECT * FROM ({slots}) WHERE token IS NOT NULL"
    sql["analyze_url_email"] = positions(found("lower(text)", URL_EMAIL))
    sql["keyword_terms"] = (
        "SELECT doc_id, lang AS term FROM documents UNION ALL SELECT doc_id, source FROM documents"
    )
    sql["term_vectors"] = f"""WITH {base()} SELECT doc_id, 'text' AS field, term, tf FROM tf
UNION ALL SELECT doc_id, 'lang', lang, 1 FROM documents"""
    sql["doc_freq"] = f"WITH {base()} SELECT term, df AS doc_freq FROM st"
    sql["ttf"] = f"WITH {base()} SELECT term, ttf FROM st"
    sql["global_stats"] = f"""WITH {base()} SELECT 'text' AS field, term, df AS doc_freq, ttf FROM st
UNION ALL SELECT 'source', source, count(*), count(*) FROM documents GROUP BY source"""
    sql["local_stats"] = f"""WITH {base("documents", "doc_id, source")}
SELECT source, 'text' AS field, term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS ttf
FROM tf GROUP BY source, term"""
    sql["vocabulary_stats"] = f"""WITH {base()},
voc AS (SELECT 'text' AS field, * FROM {words(WORDS)} UNION ALL SELECT 'lang', * FROM {words(LANGS, N)}),
known AS (SELECT 'text' AS field, term, df, ttf FROM st
  UNION ALL SELECT 'lang', lang, count(*), count(*) FROM documents GROUP BY lang)
SELECT field, term, CAST(col AS INTEGER) AS col, coalesce(df, 0) AS doc_freq, coalesce(ttf, 0) AS ttf
FROM voc LEFT JOIN known USING (field, term)"""
    # the vectorizer
    for key, value in (("binary", "1.0"), ("term_freq", "tf.tf"), ("doc_freq", "df"), ("ttf", "ttf")):
        sql[f"vec_{key}"] = f"WITH {base()} {cells(value)}"
    sql["vec_local_doc_freq"] = f"""WITH {base("documents", "doc_id, source")},
ls AS (SELECT source, term, count(*) AS ldf FROM tf GROUP BY ALL)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(ldf AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) JOIN ls USING (source, term)"""
    sql["vec_filtered_ttf"] = f"WITH {base()} {cells('ttf')} JOIN documents USING (doc_id) WHERE lang = 'fr'"
    sql["vec_numeric_span"] = f"""WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS col,
unnest(embedding) AS v FROM embeddings)
SELECT vec_id, CAST(col AS INTEGER) AS col, CAST(v AS DOUBLE) AS data FROM e WHERE col < {N_SLOTS} AND v <> 0"""
    sql["vec_array_span"] = """WITH l AS (SELECT l_orderkey, l_quantity,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS col FROM lineitem)
SELECT l_orderkey, CAST(col AS INTEGER) AS col, l_quantity AS data FROM l WHERE col < 3 AND l_quantity <> 0"""
    key = "event_id"
    sql["vec_cast"] = " UNION ALL ".join(
        [
            number("CAST(value > 50 AS INTEGER)", 0, "events", key),
            number("user_id", 1, "events", key),
            number("value", 2, "events", key),
            number("(epoch_us(ts) // 1000)", 3, "events", key),
        ]
    )
    wrapped = "(((user_id + 4294967290 + 2147483648) % 4294967296) - 2147483648)"
    sql["vec_int_compat"] = " UNION ALL ".join(
        [
            number("CAST(value > 50 AS INTEGER)", 0, "events", key),
            number(wrapped, 1, "events", key),
            f"SELECT {key}, CAST(c AS INTEGER) AS col, CAST(-1 AS DOUBLE) AS data FROM events, (VALUES (2), (3)) v(c)",
        ]
    )
    sql["vec_multi_field"] = f"{MIXED} SELECT * FROM cell"
    sql["vec_interleaved"] = f"""WITH {base()},
voc AS (SELECT * FROM {words(WORDS[:4])} UNION ALL SELECT * FROM {words(WORDS[4:], 5)})
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(tf AS DOUBLE) AS data FROM tf JOIN voc USING (term)
UNION ALL {number("n_chars", 4, "documents")}"""
    sql["vec_all_binary"] = f"""WITH {base()} {cells("1.0")}
UNION ALL {chosen("documents", "lang", LANGS, N)}"""
    pairs = "coalesce(string_agg(col || ':' || CAST(data AS VARCHAR), ' ' ORDER BY col), '')"
    sql["vec_row"] = f"""{TF} SELECT doc_id, CAST(count(col) AS INTEGER) AS n_cells, {pairs} AS cells
FROM documents LEFT JOIN cell USING (doc_id) GROUP BY doc_id"""
    sql["vec_set_value"] = f"""WITH docs AS {LABELLED}, {base("docs")},
ldf AS (SELECT lang, count(*) AS n FROM docs GROUP BY lang)
{cells("1.0")}
UNION ALL SELECT doc_id, CAST(k.col AS INTEGER), CAST(n AS DOUBLE) FROM docs JOIN ldf USING (lang) JOIN {words(LANGS, N)} k ON lang = k.term
UNION ALL {number("n_chars", N + len(LANGS), "docs")}
UNION ALL {number("toxic", N + len(LANGS) + 1, "docs")}"""
    sql["vec_extend"] = f"""WITH {base()},
voc AS (SELECT * FROM {words(WORDS)} UNION ALL SELECT * FROM {words(["to", "in"], N + 1)})
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(tf AS DOUBLE) AS data FROM tf JOIN voc USING (term)
UNION ALL {chosen("documents", "lang", ["fr"], N)}"""
    idf = "ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / CAST(df + 1 AS DOUBLE))"
    sql["tf_idf"] = f"""WITH {base()}, w AS ({cells(f"tf.tf * {idf}")})
SELECT doc_id, col, round(data, 6) AS data FROM w WHERE data <> 0"""
    # retrieval
    sql["toxic_rows"] = f"{MIXED} SELECT cell.* FROM cell JOIN labels USING (doc_id) WHERE toxic = 1"
    sql["toxic_matrix"] = f"""{MIXED},
page AS (SELECT doc_id, lang, quality, row_number() OVER (ORDER BY quality DESC, n_chars, doc_id) - 1 AS row FROM docs WHERE toxic = 1)
SELECT doc_id, row, lang, quality, {JSON} AS matrix FROM page LEFT JOIN cell USING (doc_id) WHERE row < 20 GROUP BY 1, 2, 3, 4"""
    sql["one_document"] = f"""{TF}, mine AS (SELECT * FROM cell WHERE doc_id = 7
UNION ALL {number("n_chars", N, "documents")} AND doc_id = 7)
SELECT CAST(7 AS BIGINT) AS doc_id, true AS found, CAST(1 AS INTEGER) AS n_rows, CAST({N + 1} AS INTEGER) AS n_cols, {JSON} AS matrix FROM mine"""
    sql["one_document_coo"] = f"""{TF} SELECT CAST(7 AS BIGINT) AS doc_id,
coalesce(string_agg('0', ','), '') AS row,
coalesce(string_agg(CAST(col AS VARCHAR), ',' ORDER BY col), '') AS col,
coalesce(string_agg(CAST(data AS VARCHAR), ',' ORDER BY col), '') AS data FROM cell WHERE doc_id = 7"""
    sql["missing_document"] = f"""SELECT CAST(-1 AS BIGINT) AS doc_id, false AS found, CAST(1 AS INTEGER) AS n_rows,
CAST({N} AS INTEGER) AS n_cols, CAST(NULL AS VARCHAR) AS matrix FROM documents LIMIT 1"""
    sql["search_page"] = f"""WITH {base()}, cell AS ({cells("1.0")} UNION ALL {number("n_chars", N, "documents")}),
hit AS (SELECT DISTINCT doc_id FROM tf WHERE term IN ({listed(WORDS)}) ORDER BY doc_id LIMIT 3),
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM hit)
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id)"""
    sql["match_all_documents"] = "SELECT doc_id FROM documents"
    sql["term_query"] = some_token("term = 'the'")
    sql["keyword_query"] = having("lang = 'fr'")
    sql["number_query"] = having("toxic = 1", LABELLED)
    sql["terms_query"] = some_token("term IN ('idiot', 'clown', 'le')")
    sql["match_query"] = some_token("term IN ('les', 'moron')")
    sql["match_all_terms"] = f"""WITH {base()} SELECT doc_id FROM tf WHERE term IN ('the', 'of', 'that')
GROUP BY doc_id HAVING count(*) = 3"""
    sql["prefix_query"] = some_token("starts_with(term, 'wor')")
    sql["wildcard_query"] = some_token("term LIKE 'w_r%s'")
    sql["prefix_expanded"], sql["wildcard_expanded"] = sql["prefix_query"], sql["wildcard_query"]
    # One edit from "morno": one by edit distance, or two neighbours swapped.
    sql["fuzzy_query"] = some_token(
        "levenshtein(regexp_replace(term, '[^\\x00-\\x7F]', '#', 'g'), 'morno') <= 1 OR term IN ('omrno', 'mrono', 'monro', 'moron')"
    )
    # DuckDB compares bytes: a letter outside ASCII becomes one that the word does not have.
    narrow = r"regexp_replace(term, '[^\x00-\x7F]', '#', 'g')"
    sql["fuzzy_in_rows"] = some_token(f"levenshtein({narrow}, 'idoit') <= 2")
    sql["regexp_query"] = some_token("regexp_full_match(term, '(mor|id).*t?n?s?')")
    placed = f"""pl AS (SELECT doc_id, generate_subscripts({TOKENS}, 1) AS at, unnest({TOKENS}) AS term FROM documents)"""

    def near(first: str, second: str, test: str) -> str:
        return f"""WITH {placed} SELECT DISTINCT a.doc_id FROM pl a JOIN pl b ON a.doc_id = b.doc_id
AND a.term = '{first}' AND b.term = '{second}' AND {test}"""

    sql["phrase_query"] = near("was", "the", "b.at = a.at + 1")
    sql["slop_query"] = near("that", "was", "abs(b.at - 1 - a.at) <= 4")
    sql["slop_of_equal_terms"] = near("was", "was", "b.at > a.at AND b.at - 1 - a.at <= 2")
    sql["phrase_over_stop_words"] = f"""WITH pl AS (SELECT doc_id, generate_subscripts({broken}, 1) AS at,
unnest({broken}) AS term FROM documents)
SELECT DISTINCT a.doc_id FROM pl a JOIN pl b ON a.doc_id = b.doc_id AND b.at = a.at + 2
AND lower(a.term) = 'que' AND lower(b.term) = 'de'"""
    asked_for = {
        "query_string_any": f"""list_has_any({TOKENS}, ['les', 'moron']) OR doc_id IN (SELECT a.doc_id FROM pl a JOIN pl b
ON a.doc_id = b.doc_id AND a.term = 'was' AND b.term = 'the' AND abs(b.at - 1 - a.at) <= 1)""",
        "query_string_mixed": f"""list_contains({TOKENS}, 'the') AND lang IS DISTINCT FROM 'de' AND lang IS DISTINCT FROM 'fr'
AND source IS DISTINCT FROM 'web1' AND (len(list_filter({TOKENS}, lambda t: starts_with(t, 'wor'))) > 0
OR (n_chars >= 100 AND n_chars < 900) OR doc_id IN (SELECT a.doc_id FROM pl a JOIN pl b ON a.doc_id = b.doc_id
AND a.term = 'of' AND b.term = 'the' AND b.at = a.at + 1))""",
        "query_string_all": f"""list_has_all({TOKENS}, ['of', 'that']) AND doc_id >= 100
AND len(list_filter({TOKENS}, lambda t: t LIKE 'idi_t')) = 0""",
    }
    for name, test in asked_for.items():
        sql[name] = f"WITH {placed} SELECT doc_id FROM documents WHERE {test}"
    sql["query_string_page"] = f"""{TF},
hit AS (SELECT DISTINCT d.doc_id, n_chars FROM documents d JOIN tok USING (doc_id) WHERE lang IS NOT NULL
AND (levenshtein({narrow}, 'idiot') <= 1 OR term IN ('diiot', 'iidot', 'idoit', 'idito') OR (term > 'wora' AND term <= 'worz'))),
r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS row FROM hit)
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id) WHERE row < 40"""
    sql["random_sample"] = f"""{TF},
r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id) - 1 AS row FROM documents)
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id) WHERE row < 100"""
    sql["sorted_page"] = f"""{TF},
page AS (SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY lang, n_chars DESC, doc_id) - 1 - {PAGE_FROM} AS row FROM documents),
docs AS (SELECT doc_id, CAST(row AS BIGINT) AS row, lang, n_chars FROM page WHERE row >= 0 AND row < {PAGE_SIZE})
SELECT doc_id, row, lang, n_chars, {JSON} AS matrix FROM docs LEFT JOIN cell USING (doc_id) GROUP BY 1, 2, 3, 4"""
    sql["deep_page"] = """WITH r AS (SELECT l_orderkey, l_linenumber,
row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) - 1 AS row FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(row - 20000 AS BIGINT) AS row FROM r WHERE row >= 20000 AND row < 20500"""
    sql["large_sample"] = f"""WITH r AS (SELECT o_custkey,
row_number() OVER (ORDER BY md5(o_orderkey || ':{SEED}'), o_orderkey) - 1 AS row FROM orders)
SELECT CAST(row AS BIGINT) AS row, CAST(0 AS INTEGER) AS col, CAST(o_custkey AS DOUBLE) AS data FROM r
WHERE row < 11000 AND o_custkey <> 0"""
    sql["per_shard_limit"] = """SELECT doc_id FROM (SELECT doc_id, row_number() OVER
(PARTITION BY source ORDER BY doc_id) AS n FROM documents WHERE lang = 'en') s WHERE n <= 7"""
    sql["field_projection"] = as_json(
        f"WITH {base()}, cell AS ({cells('1.0')}), docs AS (SELECT * FROM documents WHERE lang = 'es')",
        columns="doc_id, source, n_chars",
    )
    asked = listed(ASKED)
    scores = f"""s AS (SELECT doc_id, sum(tf * {idf}) AS score FROM tf JOIN st USING (term) WHERE term IN ({asked}) GROUP BY doc_id)"""
    # Sums of the same numbers in another order differ in the last bits: a tie is one to 12 digits.
    sql["relevance_topk"] = f"""WITH {base()}, {scores}
SELECT doc_id, round(score, 6) AS score FROM s ORDER BY round(score, 12) DESC, doc_id LIMIT 50"""
    sql["relevance_page"] = f"""{TF}, {scores},
r AS (SELECT doc_id, row_number() OVER (ORDER BY round(score, 12) DESC, doc_id) - 1 AS row FROM s)
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id) WHERE row < 25"""
    both = idf.replace("FROM documents", "FROM docs")
    sql["side_relevance"] = f"""WITH docs AS {LABELLED}, {base("docs")}, {scores.replace(idf, both)}
SELECT doc_id, round(score, 6) AS score FROM s ORDER BY round(score, 12) DESC, doc_id LIMIT 50"""
    sql["side_tf_idf"] = f"""WITH docs AS {LABELLED}, {base("docs")}, w AS ({cells(f"tf.tf * {both}")})
SELECT doc_id, col, round(data, 6) AS data FROM w WHERE data <> 0"""
    sql["side_doc_freq"] = f"WITH docs AS {LABELLED}, {base('docs')} {cells('df')}"
    sql["side_scope"] = f"""WITH docs AS {LABELLED}, {base("docs", "doc_id, quality")},
ls AS (SELECT quality, term, count(*) AS ldf FROM tf GROUP BY ALL)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(ldf AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) JOIN ls USING (quality, term)"""
    sql["vec_foreign_statistics"] = f"""WITH {base()},
seen AS (SELECT DISTINCT conv_id, turn, unnest({TOKENS}) AS term FROM conversations),
fs AS (SELECT term, count(*) AS fdf FROM seen GROUP BY term)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(fdf AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) JOIN fs USING (term)"""
    sql["vec_foreign_joined"] = sql["vec_foreign_statistics"]
    sql["vec_foreign_scope"] = f"""WITH {base("documents", "doc_id, source")},
fs AS (SELECT source, term, sum(tf) AS fttf FROM tf JOIN labels USING (doc_id) GROUP BY ALL)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(fttf AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) JOIN fs USING (source, term)"""
    sql["vec_foreign_scope_joined"] = sql["vec_foreign_scope"]
    has_the = f"list_contains({TOKENS}, 'the')"
    sql["all_conditions"] = having(f"{has_the} AND n_chars >= 200 AND n_chars < 3000 AND lang IS NOT NULL")
    starts = f"len(list_filter({TOKENS}, lambda t: starts_with(t, 'wor'))) > 0"
    sql["any_condition"] = having(f"lang = 'es' OR {starts} OR n_chars > 5000")
    sql["no_condition"] = having(f"NOT {has_the} AND lang IS DISTINCT FROM 'de' AND doc_id > 100")
    sql["ids_query"] = having("doc_id IN (3, 7, 11, -4)")
    sql["terminate_all"] = having("lang = 'en'") + " ORDER BY doc_id LIMIT 60"
    sql["terminate_deep"] = """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 40
ORDER BY l_orderkey, l_linenumber LIMIT 12000"""
    sql["count_only"] = f"""WITH {base()} SELECT count(DISTINCT doc_id) AS n_docs FROM tf
WHERE term IN ('idiot', 'trash')"""
    # rows and batches
    sql["row_numbers"] = (
        "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS row FROM documents"
    )
    sql["scroll_batches"] = f"{SCROLLED} SELECT batch_id, brow AS row, col, data FROM cell JOIN b USING (doc_id)"
    sql["scroll_cutoff"] = f"{sql['scroll_batches']} WHERE batch_id < 2"
    sql["written_matrix"] = sql["scroll_batches"]
    sql["written_batches"] = sql["scroll_batches"]
    sql["batch_shapes"] = f"""{SCROLLED} SELECT batch_id, count(*) AS n_rows, CAST({N} AS INTEGER) AS n_cols
FROM b GROUP BY batch_id"""
    sql["scan_export"] = f"{TF} SELECT doc_id, lang, col, data FROM cell JOIN documents USING (doc_id)"
    sql["concat_batches"] = f"{SCROLLED} SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN b USING (doc_id)"
    sql["concat_scan"] = f"""WITH {base()}, cell AS ({cells("1.0")})
SELECT (SELECT count(*) FROM documents) AS n_rows, CAST({N} AS INTEGER) AS n_cols,
count(DISTINCT doc_id) AS rows_with_cells, count(*) AS n_cells, sum(data) AS total FROM cell"""
    sql["scan_cutoff"] = "SELECT CAST(2 AS BIGINT) AS n_batches, true AS within, true AS filled FROM documents LIMIT 1"
    # matrix forms
    sql["dict_matrix"] = as_json(MIXED)
    sql["coo_matrix"] = f"""{MIXED}, r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM docs)
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id)"""
    sql["shape"] = f"SELECT count(*) AS n_rows, CAST({MIXED_COLS} AS INTEGER) AS n_cols FROM documents"
    arrays = """coalesce(string_agg(CAST(col AS VARCHAR), ',' ORDER BY col), '') AS indices,
coalesce(string_agg(CAST(data AS VARCHAR), ',' ORDER BY col), '') AS "values\""""
    sql["index_value_arrays"] = f"{MIXED} SELECT doc_id, {arrays} FROM docs LEFT JOIN cell USING (doc_id) GROUP BY doc_id"
    sql["ml_vectors"] = f"""{MIXED}, slot AS (SELECT doc_id, CAST(c.col AS INTEGER) AS col FROM docs, range({MIXED_COLS}) c(col))
SELECT doc_id, string_agg(CAST(coalesce(data, 0.0) AS VARCHAR), ',' ORDER BY col) AS features
FROM slot LEFT JOIN cell USING (doc_id, col) GROUP BY doc_id"""
    sql["features_and_label"] = as_json(
        f"{MIXED}, data AS (SELECT * FROM cell WHERE col < {MIXED_COLS - 1})",
        columns="doc_id, CAST(toxic AS DOUBLE) AS label",
    ).replace("AS matrix FROM docs LEFT JOIN cell", "AS features FROM docs LEFT JOIN data")
    sql["duplicate_sum"] = f"""WITH {base("conversations", "conv_id, turn")}
SELECT conv_id AS row, CAST(col AS INTEGER) AS col, CAST(sum(tf) AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) GROUP BY conv_id, col"""
    sql["csr_rows"] = f"""{TF}, r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents)
SELECT CAST(row AS BIGINT) AS row, {arrays} FROM cell JOIN r USING (doc_id) GROUP BY row"""
    sql["market_lines"], sql["market_batches"] = f"""{TF},
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row FROM documents),
e AS (SELECT row, col + 1 AS col, data FROM cell JOIN r USING (doc_id))
SELECT '%%MatrixMarket matrix coordinate real general' AS line
UNION ALL SELECT (SELECT count(*) FROM documents) || ' {N} ' || count(*) FROM e
UNION ALL SELECT row || ' ' || col || ' ' || data FROM e""", f"""{TF},
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents),
b AS (SELECT doc_id, CAST(floor(n / {BATCH}) AS BIGINT) AS batch_id, n % {BATCH} + 1 AS row FROM r),
e AS (SELECT batch_id, row, col + 1 AS col, data FROM cell JOIN b USING (doc_id)),
sizes AS (SELECT batch_id, count(*) AS n_rows FROM b GROUP BY 1),
nnz AS (SELECT batch_id, count(*) AS n FROM e GROUP BY 1)
SELECT batch_id, '%%MatrixMarket matrix coordinate real general' AS line FROM sizes
UNION ALL SELECT batch_id, n_rows || ' {N} ' || coalesce(n, 0) FROM sizes LEFT JOIN nnz USING (batch_id)
UNION ALL SELECT batch_id, row || ' ' || col || ' ' || data FROM e"""
    sql["written_json"] = as_json(TF, docs="documents")
    # feature selection
    best = significant(LABELLED, "toxic", "", N_SIGNIFICANT)
    sql["significant_terms"] = f"{best} SELECT key, doc_count, score, bg_count FROM best WHERE class = 1"
    sql["significant_by_class"] = f"{BY_CLASS} SELECT class, rank, key, doc_count, score, bg_count FROM best"
    sql["significant_by_language"] = (
        significant("(SELECT * FROM documents)", "lang", "", 300)
        + " SELECT class, rank, key, doc_count, score, bg_count FROM best"
    )
    sql["feature_union"] = BY_CLASS + UNION
    sql["group_count"] = "SELECT toxic AS class, count(*) AS doc_count FROM documents JOIN labels USING (doc_id) GROUP BY toxic"
    sql["labelled_matrix"] = f"""{best},
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM docs),
cell AS (SELECT doc_id, CAST(rank - 1 AS INTEGER) AS col, CAST(1 AS DOUBLE) AS data FROM dt JOIN best USING (key) WHERE best.class = 1
  UNION ALL {number("n_chars", N_SIGNIFICANT, "docs")}
  UNION ALL {number("toxic", N_SIGNIFICANT + 1, "docs")})
SELECT CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id)"""
    # learning
    sql["hash_split"] = f"""SELECT doc_id, substr(md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), 1, 4) < '{TEST_EDGE}' AS is_test
FROM documents"""
    tested = f"""SELECT doc_id, CAST(toxic AS DOUBLE) AS label, true AS answered FROM documents JOIN labels USING (doc_id)
WHERE substr(md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), 1, 4) < '{TEST_EDGE}'"""
    sql["svc_rows"] = tested
    sql["svc_check"] = f"SELECT count(*) AS n_rows, true AS holds, true AS stored FROM ({tested})"
    sql["accuracy"] = """SELECT count(*) AS n_rows, avg(CAST(1 - quality = toxic AS DOUBLE)) AS accuracy FROM labels"""
    keys = "conv_id, turn"
    sql["rescore_conversations"] = f"WITH {base('conversations', keys)} {cells('tf.tf', key=keys)}"
    # sources
    sql["json_corpus"] = "SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents"
    sql["bulk_corpus"] = "SELECT 'd' || doc_id AS _id, doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents"
    several = """joint AS (SELECT 'documents' AS _index, doc_id, text FROM documents
UNION ALL SELECT 'items', item_id, text FROM benchmark)"""
    keyed = f"WITH {several}, {base('joint', '_index, doc_id')}, cell AS ({cells('tf.tf', key='_index, doc_id')})"
    sql["one_of_several"] = f"""{keyed}, mine AS (SELECT * FROM cell WHERE _index = 'items' AND doc_id = 7)
SELECT 'items' AS _index, CAST(7 AS BIGINT) AS doc_id, true AS found, CAST(1 AS INTEGER) AS n_rows,
CAST({N} AS INTEGER) AS n_cols, {JSON} AS matrix FROM mine"""
    sql["sample_of_several"] = f"""{keyed},
r AS (SELECT _index, doc_id, row_number() OVER (ORDER BY md5(_index || ':' || doc_id || ':{SEED}'), _index, doc_id) - 1 AS row FROM joint)
SELECT _index, doc_id, CAST(row AS BIGINT) AS row, CAST(count(col) AS INTEGER) AS n_cells
FROM r LEFT JOIN cell USING (_index, doc_id) WHERE row < 60 GROUP BY ALL"""
    sql["split_of_several"] = f"""WITH {several} SELECT _index, doc_id,
substr(md5(_index || ':' || doc_id || ':{SEED}'), 1, 4) < '{TEST_EDGE}' AS is_test FROM joint"""
    sql["parsed_dates"] = "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events"
    sql["multi_table_scan"] = f"""WITH joint AS (
SELECT 'documents' AS _index, doc_id, CAST(NULL AS BIGINT) AS turn, text FROM documents
UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations),
{base("joint", "_index, doc_id, turn")} {cells("tf.tf", key="_index, doc_id, turn")}"""
    named = "UNION ALL SELECT 'benchmark', item_id, NULL, text FROM benchmark),"
    sql["wildcard_scan"] = sql["multi_table_scan"].replace("FROM conversations),", f"FROM conversations {named}")
    # streams
    sql["stream_vectorize"] = sql["vec_term_freq"]
    sql["stream_batches"] = f"""WITH {base()}, cell AS ({cells("df")}),
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents)
SELECT CAST(0 AS BIGINT) AS batch_id, CAST(row AS BIGINT) AS row, col, data FROM cell JOIN r USING (doc_id)"""
    sql["merged_statistics_batches"] = sql["stream_batches"].replace(cells("df"), cells("ttf"))
    sql["stored_statistics_matrix"] = sql["vec_ttf"]
    sql["joined_dictionary"] = f"""WITH {base()}, voc AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS col FROM st)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(df AS DOUBLE) AS data FROM tf JOIN voc USING (term)"""
    sql["stream_statistics"] = f"WITH {base()} SELECT term, df AS doc_freq, ttf FROM st"
    now = """now AS (SELECT doc_id, CASE WHEN lang = 'en' THEN substr(text, 1, 200) || ' sent again' ELSE text END AS text,
CASE WHEN lang = 'en' THEN 3 ELSE 1 END AS version FROM documents WHERE lang <> 'fr')"""
    sql["changed_statistics"] = f"""WITH {now}, {base("now")} SELECT 'text' AS field, term, df AS doc_freq, ttf FROM st"""
    sql["changed_matrix"] = f"""WITH {now}, {base()},
later AS (SELECT term, count(DISTINCT doc_id) AS ldf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM now) GROUP BY term)
SELECT doc_id, CAST(col AS INTEGER) AS col, CAST(ldf AS DOUBLE) AS data
FROM tf JOIN {words(WORDS)} voc USING (term) JOIN later USING (term)"""
    sql["latest_documents"] = f"WITH {now} SELECT doc_id, CAST(version AS INTEGER) AS version, length(text) AS n_chars FROM now"
    return sql
