"""DuckDB twins of the registered queries, as reusable table expressions."""

from __future__ import annotations

import re

from claimweave.functions import lexicons as lx
from claimweave.operators import verdict as vd
from claimweave.plans import views


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def fold(e: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({e}, '')), '\\s+', ' ', 'g'))"


def collapse(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), '\\s+', ' ', 'g'))"


def strip(e: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({e}, ''), '^\\s+', ''), '\\s+$', '')"


def distinct(e: str) -> str:
    """First-seen distinct elements of a list column."""
    return f"list_filter({e}, lambda x, i: list_position({e}, x) = i)"


def found(terms: str, text: str) -> str:
    return f"len(list_filter({terms}, lambda z: contains({text}, z)))"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE ({a})::DOUBLE / ({b})::DOUBLE END)"


def entity_name(e: str) -> str:
    return f"trim(regexp_replace(regexp_replace({fold(e)}, '[^\\p{{L}}\\p{{N}}_\\sऀ-ॿ-]', ' ', 'g'), '\\s+', ' ', 'g'))"


def variants(name: str) -> str:
    parts = f"string_split({name}, ' ')"
    full = (
        f"[{name}, CASE WHEN len({parts}) >= 2 THEN array_to_string({parts}[-2:], ' ') END, "
        f"CASE WHEN len({parts}) >= 3 THEN array_to_string({parts}[-3:], ' ') END]"
    )
    kept = f"list_filter({full}, lambda v: v IS NOT NULL)"
    return f"(CASE WHEN {name} = '' THEN [] ELSE {distinct(kept)} END)"


def ngrams(w: str, n: int, least: int) -> str:
    return (
        f"list_filter(list_transform(range(1, len({w}) - {n} + 2), lambda i: "
        f"array_to_string({w}[i:i + {n} - 1], ' ')), lambda p: length(p) >= {least})"
    )


TOKEN = "[a-zA-ZÀ-ÿऀ-ॿ0-9]+"

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTE[name] = (needs.split(), body)


def query(final: str, *needs: str, **other_tables: tuple[str, str]) -> str:
    """``final`` preceded by every table expression it needs, in order.

    ``other_tables`` are used in place of the expressions of the same name, as (needs, body).
    """
    order: list[str] = []
    tables = CTE | {name: (names.split(), body) for name, (names, body) in other_tables.items()}

    def visit(name):
        if name not in order:
            for other in tables[name][0]:
                visit(other)
            order.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({tables[n][1]})" for n in order)
    return decimal_rounding((f"WITH {parts}\n" if parts else "") + final)


def decimal_rounding(statement: str) -> str:
    """Round the printed decimal value half up, as Spark does."""
    out, rest = "", statement
    while (match := re.search(r"\bround\(", rest)) is not None:
        depth, comma, i = 1, None, match.end()
        while depth:
            depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(rest[i], 0)
            if rest[i] == "," and depth == 1:
                comma = i
            i += 1
        value = decimal_rounding(rest[match.end() : comma])
        out += f"{rest[: match.start()]}round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)){rest[comma : i]}::DOUBLE"
        rest = rest[i:]
    return out + rest


cte("articles", "", """
SELECT d.doc_id AS article_id, concat('https://', d.source, '.example/', CAST(d.doc_id AS VARCHAR)) AS url,
  split_part(d.text, chr(10), 1) AS title, d.text AS content, l.quality AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
cte("labelled", "articles", "SELECT * FROM articles WHERE label IS NOT NULL")
cte("sample", "labelled", """
SELECT article_id, url, title, content, label FROM (SELECT *, row_number() OVER (PARTITION BY label
  ORDER BY md5(concat(CAST(article_id AS VARCHAR), ':42')), article_id) AS rn FROM labelled) WHERE rn <= 5""")

_ENT = "list_sort(list_distinct(regexp_extract_all({0}, '[\\p{{L}}]{{6,}}')))"
_NUM = "list_sort(list_distinct(regexp_extract_all({0}, '[0-9]{{2,}}')))"
cte("claims", "sample", f"""
SELECT article_id AS claim_id, title AS claim, title AS source_title, content AS source_content,
  {_ENT.format('title')} AS entities, {_NUM.format('content')} AS numbers_dates,
  article_id AS exclude_article_id FROM sample
UNION ALL SELECT -1 - item_id, text, text, text, {_ENT.format('text')}, {_NUM.format('text')}, NULL FROM benchmark""")
cte("vectors", "", "SELECT vec_id AS article_id, embedding::DOUBLE[] AS v FROM embeddings")
cte("claim_vectors", "claims vectors", """
SELECT c.claim_id, v.v FROM claims c JOIN vectors v
  ON v.article_id = CASE WHEN c.claim_id < 0 THEN -1 - c.claim_id ELSE c.claim_id END""")

cte("queries", "claims", """
SELECT *, concat(claim, '. ', source_title, '. ', array_to_string(entities, ' '), '. ', array_to_string(numbers_dates, ' ')) AS q_semantic,
  concat(source_title, ' ', source_content) AS q_original,
  concat(claim, ' ', array_to_string(entities, ' '), ' ', array_to_string(numbers_dates, ' ')) AS q_claim
FROM claims WHERE trim(claim) <> ''""")
cte("prep1", "queries", f"""
SELECT *, list_transform(entities, lambda e: {entity_name('e')}) AS names,
  list_transform(numbers_dates, lambda n: {fold('n')}) AS numbers,
  list_filter(regexp_extract_all({fold('claim')}, '{TOKEN}'), lambda w: NOT list_contains({words(lx.RETRIEVAL_STOPWORDS)}, w)) AS kept
FROM queries""")
cte("prep2", "prep1", f"""
SELECT *, list_transform(names, lambda n: {variants('n')}) AS vars,
  list_transform(list_filter(names, lambda n: n <> '' AND NOT list_contains({words(lx.BROAD_ENTITIES)}, n)), lambda n: {variants('n')}) AS specific,
  list_filter({distinct('kept')}, lambda t: length(t) >= 4) AS tokens,
  list_filter(kept, lambda w: length(w) >= 3) AS w
FROM prep1""")
cte("prep3", "prep2", f"""
SELECT *, list_filter(tokens, lambda t: NOT list_contains({words(lx.GENERIC_EVENT_WORDS)}, t)) AS specific_tokens,
  list_concat({ngrams('w', 4, 12)}, {ngrams('w', 3, 10)}, {ngrams('w', 2, 8)}, {ngrams('w', 1, 7)}) AS grams,
  flatten(vars) AS all_vars
FROM prep2""")
cte("prep4", "prep3", f"""
SELECT *, list_concat(({distinct('grams')}), all_vars) AS phr, list_filter(all_vars, lambda v: length(v) >= 3) AS idv
FROM prep3""")
cte("prepared", "prep4", f"""
SELECT claim_id, claim, exclude_article_id, q_original, q_claim, entities, names, vars, specific, numbers, tokens,
  CASE WHEN len(specific_tokens) > 0 THEN specific_tokens ELSE tokens END AS distinctive,
  ({distinct('phr')}) AS phrases, list_filter(({distinct('phr')}), lambda p: contains(p, ' ')) AS multi,
  {distinct('idv')} AS identity_variants
FROM prep4""")


def window(n: int | None = None) -> str:
    content = "coalesce(content, '')"
    return fold(f"concat(coalesce(title, ''), ' ', {f'substr({content}, 1, {n})' if n else content})")


cte("windows", "articles", f"""
SELECT article_id, {fold('title')} AS title_n, {fold('content')} AS content_w,
  {window()} AS entity_w, {window()} AS event_w, {window()} AS fact_w,
  regexp_replace({window()}, '[^\\p{{Nd}}]', '', 'g') AS event_digits,
  {fold('content')} AS identity_content
FROM articles""")
# The preset lengths, by article.
cte("fixed_windows", "articles", f"""
SELECT article_id, {fold('substr(content, 1, 7000)')} AS content_w, {window(5000)} AS entity_w, {window(7000)} AS event_w,
  {window(1500)} AS fact_w, substr({fold('content')}, 1, 7000) AS identity_content
FROM articles""")


def lexical(name: str, source: str, key: str, text: str, channel: str, needs: str) -> None:
    """``<name>_cnt``: term counts of one text column."""
    if channel == "word":
        cte(f"{name}_tok", needs, f"""
SELECT {key}, unnest(l) AS c, generate_subscripts(l, 1) AS p FROM (
  SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS l FROM {source})""")
        cte(f"{name}_cnt", f"{name}_tok", f"""
SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest([c, c || ' ' || c2]) AS term FROM (
  SELECT {key}, c, lead(c) OVER (PARTITION BY {key} ORDER BY p) AS c2 FROM {name}_tok)) WHERE term IS NOT NULL GROUP BY ALL""")
        return
    cte(f"{name}_ch", needs, f"""
SELECT {key}, unnest(c) AS c, generate_subscripts(c, 1) AS p FROM (SELECT {key}, string_split(
  regexp_replace(lower({text}), '\\s\\s+', ' ', 'g'), '') AS c FROM {source})""")
    cte(f"{name}_cnt", f"{name}_ch", f"""
SELECT {key}, term, count(*) AS tf FROM (
  SELECT {key}, unnest([c || c2 || c3, c || c2 || c3 || c4, c || c2 || c3 || c4 || c5]) AS term FROM (
    SELECT {key}, c, lead(c, 1) OVER w AS c2, lead(c, 2) OVER w AS c3, lead(c, 3) OVER w AS c4, lead(c, 4) OVER w AS c5
    FROM {name}_ch WINDOW w AS (PARTITION BY {key} ORDER BY p)))
WHERE term IS NOT NULL GROUP BY ALL""")


def weighted(name: str, key: str, vocabulary: str) -> None:
    cte(name, f"{name}_cnt {vocabulary}", f"""
SELECT {key}, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS w FROM (
  SELECT p.{key}, p.term, (1.0 + ln(p.tf::DOUBLE)) * v.idf AS raw FROM {name}_cnt p JOIN {vocabulary} v USING (term))""")


cte("search", "articles", f"SELECT article_id, {collapse("concat_ws(' ', coalesce(title, ''), coalesce(title, ''), coalesce(content, ''))")} AS t FROM articles")
for _channel, _rule in (("word", "df >= 2 AND df <= 0.98::DOUBLE * n"), ("char", "df >= 3")):
    lexical(f"{_channel}_post", "search", "article_id", "t", _channel, "search")
    cte(f"{_channel}_voc", f"{_channel}_post_cnt articles", f"""
SELECT term, df, total, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS total, (SELECT count(*) FROM articles)::DOUBLE AS n
  FROM {_channel}_post_cnt GROUP BY term) WHERE {_rule}""")
    weighted(f"{_channel}_post", "article_id", f"{_channel}_voc")
for _name, _text, _channel in (("qwo", "q_original", "word"), ("qwc", "q_claim", "word"), ("qch", "q_original", "char")):
    lexical(_name, "queries", "claim_id", _text, _channel, "queries")
    weighted(_name, "claim_id", f"{_channel}_voc")
    cte(f"{_name}_s", f"{_name} {_channel}_post", f"""
SELECT q.claim_id, p.article_id, round(sum(q.w * p.w), 8) AS s FROM {_channel}_post p JOIN {_name} q USING (term) GROUP BY ALL""")

cte("sem_s", "claim_vectors vectors", """
SELECT c.claim_id, v.article_id, round(list_dot_product(c.v, v.v), 8) AS s FROM claim_vectors c, vectors v""")
for _name, _n in (("sem_s", 150), ("qwo_s", 150), ("qwc_s", 100), ("qch_s", 150)):
    _keep = "" if _name == "sem_s" else "WHERE s > 0"
    cte(f"{_name}_top", _name, f"""
SELECT claim_id, article_id, s, rank FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY s DESC, article_id) AS rank
  FROM {_name} {_keep}) WHERE rank <= {_n}""")

_NUMBERS = (
    "len(list_filter(numbers, lambda n: n <> '' AND (contains({text}, n) OR "
    "(length(regexp_replace(n, '[^\\p{{Nd}}]', '', 'g')) >= 2 AND contains({digits}, regexp_replace(n, '[^\\p{{Nd}}]', '', 'g'))))))"
)
cte("id_hits", "prepared windows", f"""
SELECT * FROM (SELECT p.claim_id, p.exclude_article_id, p.phrases, p.numbers, w.article_id, w.title_n, w.identity_content,
  {found('p.identity_variants', "concat(w.title_n, ' ', w.identity_content)")} AS hits FROM prepared p, windows w) WHERE hits > 0""")
cte("identity", "id_hits", f"""
SELECT claim_id, article_id, hits FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY hits DESC, article_id) AS position FROM id_hits
  WHERE article_id IS DISTINCT FROM exclude_article_id AND (hits >= 2
    OR {ratio("len(list_filter(phrases, lambda p: contains(title_n, p) OR contains(identity_content, p)))", 'len(phrases)')} >= 0.15
    OR {ratio(_NUMBERS.format(text="concat(title_n, ' ', identity_content)", digits="regexp_replace(concat(title_n, ' ', identity_content), '[^\\p{Nd}]', '', 'g')"), 'len(numbers)')} >= 0.20))
WHERE position <= 300""")

SIGNAL_SELECT = f"""
  {ratio('len(matched)', 'len(vars)')} AS entity_match,
  CASE WHEN len(vars) >= 4 THEN CASE WHEN cooc >= 4 THEN 1.0 WHEN cooc = 3 THEN 0.75 WHEN cooc = 2 THEN 0.5 WHEN cooc = 1 THEN 0.15 ELSE 0.0 END
    WHEN len(vars) = 3 THEN CASE WHEN cooc = 3 THEN 1.0 WHEN cooc = 2 THEN 0.65 WHEN cooc = 1 THEN 0.2 ELSE 0.0 END
    WHEN len(vars) = 2 THEN CASE WHEN cooc = 2 THEN 1.0 WHEN cooc = 1 THEN 0.3 ELSE 0.0 END
    WHEN len(vars) = 1 AND cooc = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS entity_cooccurrence,
  {ratio('phrase_n', 'len(phrases)')} AS phrase_match,
  CASE WHEN len(tokens) = 0 THEN 0.0 ELSE least(1.0, 0.30::DOUBLE * {ratio('token_title', 'len(tokens)')} + 0.20::DOUBLE * {ratio('token_content', 'len(tokens)')}
    + 0.30::DOUBLE * least(multi_n / 5.0::DOUBLE, 1.0) + 0.20::DOUBLE * least(multi_title / 3.0::DOUBLE, 1.0)) END::DOUBLE AS event_specificity,
  CASE WHEN len(tokens) = 0 THEN 0.0 ELSE least(1.0, 0.55::DOUBLE * {ratio('dist_title', 'len(distinctive)')} + 0.25::DOUBLE * {ratio('dist_content', 'len(distinctive)')}
    + CASE WHEN dist_title >= 4 THEN 0.30 WHEN dist_title >= 3 THEN 0.20 WHEN dist_title >= 2 THEN 0.10 ELSE 0.0 END::DOUBLE) END::DOUBLE AS claim_event_overlap,
  {ratio('number_n', 'len(numbers)')} AS number_date_match,
  CASE WHEN {found(words(lx.RETRIEVAL_FACT_CHECK_TERMS), 'fact_w')} > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS fact_check_score,
  len(specific) AS n_specific, specific_hits"""


def signal_ctes(name: str, pairs: str) -> None:
    """``<name>``: signals of every pair of the table expression ``pairs`` (claim_id, article_id, ...)."""
    inner = lambda text: f"lambda e: {found('e', text)} > 0"
    cte(f"{name}_h", f"{pairs} prepared windows", f"""
SELECT x.*, p.* EXCLUDE (claim_id, exclude_article_id), w.* EXCLUDE (article_id),
  list_filter(p.vars, {inner('w.entity_w')}) AS matched,
  len(list_filter(p.vars, {inner('w.event_w')})) AS cooc,
  len(list_filter(p.specific, {inner('w.event_w')})) AS specific_hits,
  {_NUMBERS.replace('numbers', 'p.numbers', 1).format(text='w.event_w', digits='w.event_digits')} AS number_n,
  len(list_filter(p.phrases, lambda z: contains(w.title_n, z) OR contains(w.content_w, z))) AS phrase_n,
  len(list_filter(p.multi, lambda z: contains(w.title_n, z) OR contains(w.content_w, z))) AS multi_n,
  {found('p.multi', 'w.title_n')} AS multi_title,
  {found('p.tokens', 'w.title_n')} AS token_title, {found('p.tokens', 'w.content_w')} AS token_content,
  {found('p.distinctive', 'w.title_n')} AS dist_title, {found('p.distinctive', 'w.content_w')} AS dist_content
FROM {pairs} x JOIN prepared p USING (claim_id) JOIN windows w USING (article_id)""")
    cte(name, f"{name}_h", f"""
SELECT h.*, {SIGNAL_SELECT} FROM (SELECT * EXCLUDE (specific_hits), specific_hits FROM {name}_h) h""".replace(
        "n_specific, specific_hits", "n_specific"))


signal_ctes("id_signals", "identity")

cte("pool", "sem_s_top qwo_s_top qwc_s_top qch_s_top identity", """
SELECT claim_id, article_id, max(i) = 1 AS identity_candidate FROM (
  SELECT claim_id, article_id, 0 AS i FROM sem_s_top UNION ALL SELECT claim_id, article_id, 0 FROM qwo_s_top
  UNION ALL SELECT claim_id, article_id, 0 FROM qwc_s_top UNION ALL SELECT claim_id, article_id, 0 FROM qch_s_top
  UNION ALL SELECT claim_id, article_id, 1 FROM identity) GROUP BY ALL""")
cte("scored", "pool sem_s qwo_s qwc_s qch_s", """
SELECT p.claim_id, p.article_id, p.identity_candidate, coalesce(s.s, 0.0) AS semantic_score,
  0.55::DOUBLE * coalesce(o.s, 0.0) + 0.45::DOUBLE * coalesce(h.s, 0.0) AS lexical_score, coalesce(c.s, 0.0) AS claim_lexical_score
FROM pool p LEFT JOIN sem_s s USING (claim_id, article_id) LEFT JOIN qwo_s o USING (claim_id, article_id)
  LEFT JOIN qch_s h USING (claim_id, article_id) LEFT JOIN qwc_s c USING (claim_id, article_id)""")


def minmax(c: str) -> str:
    low, high = f"min({c}) OVER (PARTITION BY claim_id)", f"max({c}) OVER (PARTITION BY claim_id)"
    return f"CASE WHEN {high} - {low} < 1e-8 THEN 1.0 ELSE ({c} - {low}) / ({high} - {low}) END"


cte("normed", "scored", f"""
SELECT *, {minmax('semantic_score')} AS semantic_norm, {minmax('lexical_score')} AS lexical_norm, {minmax('claim_lexical_score')} AS claim_norm
FROM scored""")
cte("kept", "normed claims", """
SELECT n.* FROM normed n JOIN claims c USING (claim_id) WHERE n.article_id IS DISTINCT FROM c.exclude_article_id""")
signal_ctes("signals", "kept")
cte("flagged", "signals", """
SELECT *, entity_match >= 0.20 OR entity_cooccurrence >= 0.35 AS strong_identity,
  phrase_match >= 0.15 OR event_specificity >= 0.25 OR claim_event_overlap >= 0.25 AS strong_event,
  claim_lexical_score >= 0.20 OR lexical_score >= 0.30 AS strong_claim FROM signals""")
cte("relevant", "flagged", """
SELECT *, (0.14::DOUBLE * semantic_norm + 0.08::DOUBLE * lexical_norm + 0.15::DOUBLE * claim_norm + 0.15::DOUBLE * entity_match
    + 0.18::DOUBLE * entity_cooccurrence + 0.10::DOUBLE * phrase_match + 0.08::DOUBLE * event_specificity + 0.12::DOUBLE * claim_event_overlap
    + 0.06::DOUBLE * number_date_match + 0.08::DOUBLE * fact_check_score
    + ((CASE WHEN identity_candidate THEN 0.12 ELSE 0.0 END)::DOUBLE + (CASE WHEN strong_identity AND strong_event THEN 0.10 ELSE 0.0 END)::DOUBLE
    + (CASE WHEN entity_cooccurrence >= 0.65 AND (event_specificity >= 0.30 OR claim_event_overlap >= 0.30) THEN 0.10 ELSE 0.0 END)::DOUBLE))
  * ((CASE WHEN NOT strong_identity AND NOT strong_event AND NOT strong_claim THEN 0.35 ELSE 1.0 END)::DOUBLE
    * (CASE WHEN entity_match = 0 AND entity_cooccurrence = 0 AND phrase_match < 0.10 AND claim_lexical_score < 0.10 THEN 0.45 ELSE 1.0 END)::DOUBLE
    * (CASE WHEN n_specific > 0 AND specific_hits = 0 THEN 0.50 ELSE 1.0 END)::DOUBLE) AS raw_relevance,
  CASE WHEN fact_check_score > 0 THEN 'FACT_CHECK' ELSE 'NEWS' END AS evidence_type
FROM flagged""")
_R4 = ["semantic_score", "lexical_score", "claim_lexical_score", "entity_match", "entity_cooccurrence", "phrase_match",
       "event_specificity", "claim_event_overlap", "number_date_match", "fact_check_score"]
cte("rounded", "relevant", f"""
SELECT claim_id, article_id, {', '.join(f'round({c}, 4) AS {c}' for c in _R4)}, identity_candidate,
  round(raw_relevance, 4) AS relevance, evidence_type, strong_identity, strong_event, strong_claim FROM relevant""")
cte("retrieved", "rounded", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY relevance DESC, entity_cooccurrence DESC,
  event_specificity DESC, semantic_score DESC, article_id) AS retrieval_rank FROM rounded) WHERE retrieval_rank <= 12""")


def word_list(e: str) -> str:
    return f"list_distinct(regexp_extract_all({e}, '[\\p{{L}}\\p{{N}}]+'))"


def shared(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def rerank_ctes(name: str, source: str, phrase: str = "0.0::DOUBLE") -> None:
    """Evidence of a candidate table: ``<name>`` keeps the top 3."""
    cte(f"{name}_1", f"{source} claims articles", f"""
SELECT r.*, a.title, a.content, a.url, a.label, {word_list(fold('c.claim'))} AS qw,
  {fold('a.title')} AS tn, {fold('a.content')} AS cn
FROM {source} r JOIN claims c USING (claim_id) JOIN articles a USING (article_id)""")
    cte(f"{name}_2", f"{name}_1", f"""
SELECT *, {word_list('tn')} AS tw, {word_list('cn')} AS cw,
  list_filter(qw, lambda t: length(t) > 1 AND NOT list_contains({words(lx.RERANK_STOPWORDS)}, t)) AS kept,
  CASE WHEN {found(words(lx.RERANK_FACT_CHECK_TERMS), 'tn')} > 0 THEN 1.0 WHEN {found(words(lx.RERANK_FACT_CHECK_TERMS), 'cn')} > 0 THEN 0.7 ELSE 0.0 END::DOUBLE AS found_fact
FROM {name}_1""")
    cte(f"{name}_3", f"{name}_2", f"""
SELECT *, CASE WHEN len(kept) > 0 THEN kept ELSE qw END AS ew, least(greatest(semantic_score, 0.0), 1.0) AS s_sem,
  least(greatest(lexical_score, 0.0), 1.0) AS s_lex, {phrase} AS s_phr, least(greatest(fact_check_score, found_fact)) AS s_fact
FROM {name}_2""")
    cte(f"{name}_4", f"{name}_3", f"""
SELECT *, greatest(least(claim_lexical_score, 1.0), least(greatest(0.70::DOUBLE * {ratio(shared('ew', 'tw'), 'len(ew)')}
    + 0.30::DOUBLE * {ratio(shared('ew', 'cw'), 'len(ew)')}, 0.0), 1.0)) AS s_claim,
  {ratio(shared('qw', 'tw'), 'len(qw)')} AS s_dir
FROM {name}_3""")
    cte(f"{name}_5", f"{name}_4", """
SELECT *, least(greatest(0.15::DOUBLE * s_sem + 0.10::DOUBLE * s_lex + 0.22::DOUBLE * s_claim + 0.15::DOUBLE * s_phr + 0.15::DOUBLE * entity_match
    + 0.09::DOUBLE * number_date_match + 0.10::DOUBLE * s_fact + 0.04::DOUBLE * s_dir, 0.0), 1.0) AS score FROM {0}_4""".format(name))
    cte(f"{name}_6", f"{name}_5", f"""
SELECT claim_id, concat('E', CAST(article_id AS VARCHAR)) AS evidence_id, article_id, title, content, url, label,
  round(s_sem, 4) AS semantic_score, round(s_lex, 4) AS lexical_score, round(s_claim, 4) AS claim_match, round(s_phr, 4) AS phrase_match_score,
  round(entity_match, 4) AS entity_match, round(number_date_match, 4) AS number_date_match, round(s_fact, 4) AS fact_check_score,
  round(s_dir, 4) AS directness_score, round(score, 4) AS evidence_score, evidence_type, retrieval_rank,
  ((evidence_type LIKE 'FACT_CHECK%' AND s_claim >= 0.20 AND (s_phr >= 0.10 OR entity_match >= 0.20 OR s_lex >= 0.15) AND score >= 0.30)
   OR (score >= 0.55 AND s_sem >= 0.70 AND s_claim >= 0.30 AND (entity_match >= 0.20 OR s_phr >= 0.20 OR number_date_match >= 0.20))
   OR (score >= 0.45 AND s_claim >= 0.35 AND entity_match >= 0.30 AND (s_lex >= 0.15 OR s_phr >= 0.15))
   OR (score >= 0.45 AND s_claim >= 0.30 AND (s_phr >= 0.30 OR number_date_match >= 0.40) AND (entity_match >= 0.20 OR s_dir >= 0.30))) AS strong_evidence
FROM {name}_5""")
    cte(name, f"{name}_6", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY strong_evidence DESC, evidence_score DESC, claim_match DESC,
  entity_match DESC, phrase_match_score DESC, retrieval_rank) AS rank FROM {name}_6) WHERE rank <= 3""")


rerank_ctes("evidence", "retrieved")
# Every candidate a second time, further down, with another claim score.
cte("doubled", "retrieved", """
SELECT * FROM retrieved UNION ALL
SELECT * REPLACE (retrieval_rank + 12 AS retrieval_rank, CASE WHEN article_id % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS claim_lexical_score) FROM retrieved""")
rerank_ctes("evidence_d", "doubled")
rerank_ctes("evidence_p", "retrieved", "least(greatest(phrase_match, 0.0), 1.0)")

cte("raw_sheet", "", """
SELECT URL, TITLE, CONTENT, BOOL FROM (SELECT concat(' https://', source, '.example/', CAST(doc_id AS VARCHAR)) AS URL,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat('  ', split_part(text, chr(10), 1), chr(10)) END AS TITLE,
  text AS CONTENT,
  CASE doc_id % 8 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '1.0' WHEN 3 THEN 'x' WHEN 4 THEN NULL WHEN 5 THEN '0' WHEN 6 THEN '1d' ELSE '0f' END AS BOOL,
  unnest([1, 2]) AS copy FROM documents)""")
cte("cleaned", "raw_sheet", f"""
SELECT row_number() OVER (ORDER BY url, title, content, label) AS article_id, * FROM (
  SELECT {strip('URL')} AS url, {strip('TITLE')} AS title, {strip('CONTENT')} AS content,
    CAST(trunc(TRY_CAST(trim(BOOL) AS DOUBLE)) AS INT) AS label FROM (SELECT DISTINCT * FROM raw_sheet))
WHERE label IS NOT NULL""")
cte("predictions", "labelled", """
SELECT a.article_id, a.label AS true_label, CASE WHEN a.article_id % 11 = 0 THEN 'ERROR' WHEN a.article_id % 7 = 0 THEN 'UNCERTAIN'
    WHEN l.toxic = 1 OR a.article_id % 5 = 0 THEN 'FAKE' ELSE 'REAL' END AS predicted_verdict,
  CASE WHEN a.article_id % 11 = 0 THEN NULL ELSE 0.5::DOUBLE + CAST(a.article_id % 50 AS DOUBLE) / 100 END AS confidence,
  CASE WHEN a.article_id % 11 = 0 THEN NULL ELSE CAST(a.article_id % 400 AS DOUBLE) / 10 END AS processing_time_seconds
FROM labelled a JOIN labels l ON a.article_id = l.doc_id""")
cte("responses", "", f"SELECT doc_id AS claim_id, CASE doc_id % {views.REPLY_KINDS} " + " ".join(
    f"WHEN {k} THEN {quoted(v)}" for k, v in views.REPLIES.items()) + " END AS raw FROM labels")
_F1 = f"regexp_replace(regexp_replace({strip('raw')}, '^```json\\s*', '', 'i'), '^```\\s*', '')"
cte("replies", "responses", f"""
SELECT *, CASE WHEN json_valid(whole) THEN whole WHEN json_valid(part) THEN part END AS json FROM (
  SELECT *, regexp_extract(whole, '(?s)\\{{.*\\}}') AS part FROM (
    SELECT claim_id, {strip(f"regexp_replace({_F1}, '\\s*```$', '')")} AS whole FROM responses))""")
cte("verdicts", "replies", f"""
SELECT claim_id, json, CASE WHEN json IS NULL THEN 'no valid JSON' WHEN json_type(json) <> 'OBJECT' THEN 'not a JSON object' END AS error,
  CASE WHEN upper(trim(json_extract_string(json, '$.verdict'))) IN ('FAKE', 'REAL', 'UNCERTAIN') THEN upper(trim(json_extract_string(json, '$.verdict'))) ELSE 'UNCERTAIN' END AS verdict,
  round(least(greatest(CASE json_type(json, '$.confidence') WHEN 'BOOLEAN' THEN CAST(CAST(json_extract(json, '$.confidence') AS BOOLEAN) AS DOUBLE)
    ELSE coalesce(TRY_CAST(json_extract_string(json, '$.confidence') AS DOUBLE), 0.0) END, 0.0), 1.0), 4) AS confidence,
  coalesce(nullif(trim(json_extract_string(json, '$.explanation')), ''), {quoted(vd.NO_EXPLANATION)}) AS explanation,
  nullif(trim(json_extract_string(json, '$.summary')), '') AS own_summary
FROM replies""")
cte("good", "verdicts", "SELECT claim_id, verdict, confidence, explanation, coalesce(own_summary, explanation) AS summary, json FROM verdicts WHERE error IS NULL")
cte("requests", "", """
SELECT item_id AS request_id, CASE WHEN item_id % 4 = 0 THEN concat(' ', text, ' ') END AS question,
  CASE WHEN item_id % 4 = 1 THEN text WHEN item_id % 4 = 2 THEN '  ' ELSE '' END AS title, CASE WHEN item_id % 4 = 2 THEN text END AS content
FROM benchmark""")
cte("request_norm", "requests", f"""
SELECT request_id, coalesce(nullif({strip('title')}, ''), nullif({strip('question')}, ''), '') AS title,
  coalesce(nullif({strip('content')}, ''), nullif({strip('question')}, ''), '') AS content FROM requests""")
cte("counts", "predictions", """
SELECT count(*) AS total, count(*) FILTER (predicted_verdict = 'UNCERTAIN') AS uncertain, count(*) FILTER (predicted_verdict = 'ERROR') AS errors,
  count(*) FILTER (predicted_verdict IN ('FAKE', 'REAL')) AS valid,
  count(*) FILTER (true_label = 0 AND predicted_verdict = 'FAKE') AS c00, count(*) FILTER (true_label = 0 AND predicted_verdict = 'REAL') AS c01,
  count(*) FILTER (true_label = 1 AND predicted_verdict = 'FAKE') AS c10, count(*) FILTER (true_label = 1 AND predicted_verdict = 'REAL') AS c11,
  avg(confidence) AS conf, avg(processing_time_seconds) AS secs FROM predictions""")
cte("per_class", "counts", f"""
SELECT 'FAKE' AS name, {ratio('c00', 'c00 + c10')} AS precision, {ratio('c00', 'c00 + c01')} AS recall, {ratio('2 * c00', '2 * c00 + c10 + c01')} AS f1, c00 + c01 AS support FROM counts
UNION ALL SELECT 'REAL', {ratio('c11', 'c11 + c01')}, {ratio('c11', 'c11 + c10')}, {ratio('2 * c11', '2 * c11 + c10 + c01')}, c10 + c11 FROM counts""")
