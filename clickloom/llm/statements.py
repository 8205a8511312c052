"""DuckDB statements for the queries whose results SQL can state.

They follow the definitions, not the Spark plans: all pairs, windows over whole
groups and recursion, as small tables allow. Token ids and 64-bit shingle hashes have
no SQL, so op4, op8, op10 and the pipeline are tested against brute force instead.
"""

from __future__ import annotations

from clickloom.llm.fim import Fim
from clickloom.llm.licences import EVERY, RUN, Votes
from clickloom.llm.quality import RiskLimits
from clickloom.llm.queries import MIX, SHARD_BYTES
from clickloom.llm.spelling import Variants

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SPACE = r"\x20\x09-\x0D"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _mixing() -> str:
    seed = MIX.seed
    return f"""
WITH RECURSIVE items AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS of, coalesce(doc_id::varchar, 'null') || '-' || md5(coalesce(text, '')) AS known,
         len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) + 1 AS n_tokens
  FROM documents
),
sources AS (SELECT of, sum(n_tokens)::bigint AS tokens FROM items GROUP BY 1),
spread AS (SELECT max(tokens)::double / min(tokens) AS r, sum(tokens)::double AS total FROM sources),
halving(step, low, high) AS (
  SELECT 0, 0.0::double, 1.0::double
  UNION ALL
  SELECT step + 1, CASE WHEN pow(r, 1 - (low + high) / 2) > {MIX.repetitions} THEN (low + high) / 2 ELSE low END,
         CASE WHEN pow(r, 1 - (low + high) / 2) > {MIX.repetitions} THEN high ELSE (low + high) / 2 END
  FROM halving, spread WHERE step < 36
),
alpha AS (SELECT CASE WHEN pow(r, 1) <= {MIX.repetitions} THEN 0 ELSE high END AS a FROM halving, spread WHERE step = 36),
weighted AS (
  SELECT of, tokens, pow(tokens / total, a) / sum(pow(tokens / total, a)) OVER () AS weight FROM sources, spread, alpha
),
aimed AS (
  SELECT *, greatest(tokens, round(weight * max(tokens / weight) OVER ())::bigint) AS goal FROM weighted
),
quotas AS (
  SELECT *, greatest(1, ceil(goal / greatest(1, ceil(sum(goal) OVER () / {MIX.block_tokens}))))::bigint AS quota FROM aimed
),
copies AS (
  SELECT doc_id, source, known, n_tokens, weight, goal, quota, epoch,
         epoch * tokens + coalesce(sum(n_tokens) OVER (
           PARTITION BY of, epoch ORDER BY md5('{seed}-' || epoch || '-' || known), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM items JOIN quotas USING (of), range(0, 64) e(epoch) WHERE epoch < ceil(goal / tokens)
)
SELECT doc_id, source, n_tokens::bigint AS n_tokens, round(weight, 9) AS weight, epoch::int AS epoch,
       (start // quota)::bigint AS block,
       row_number() OVER (PARTITION BY start // quota ORDER BY md5('block-{seed}-' || epoch || '-' || known), doc_id) - 1 AS position
FROM copies WHERE start < goal"""


def _licences() -> str:
    votes = Votes()

    def row(i: int, t) -> str:
        least = 1.0 if t.exact else votes.coverage if t.coverage is None else t.coverage
        alone = t.exact or t.coverage is not None
        needs = ", ".join(map(_text, t.needs))
        return f"({i}, {_text(t.label)}, {_text(t.family or t.label)}, {t.exact}, {alone}, {t.run == RUN}, {least}::double, [{needs}]::varchar[], {_text(t.text)})"

    rows = ", ".join(row(i, t) for i, t in enumerate(EVERY))
    words = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    held = lambda a, b: f"list_contains(places, p + {a}) AND list_contains(places, p + {b})"
    strong = f"list_filter(places, lambda p: {held(-2, -1)} OR {held(-1, 1)} OR {held(1, 2)})"
    return f"""
WITH templates AS (
  SELECT *, {words.format('txt')} AS w FROM (VALUES {rows}) t(template, label, family, exact, alone, runs, least, needs, txt)
),
grams AS (
  SELECT template, label, family, exact, alone, runs, least, needs, len(w) - 1 AS n_grams, i - 1 AS place, w[i] || ' ' || w[i + 1] AS gram
  FROM templates, unnest(range(1, len(w))) u(i)
),
docs AS (SELECT row_number() OVER () AS row, doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
hits AS (
  SELECT row, template, i - 1 - place AS diagonal, place
  FROM (SELECT row, i, w[i] || ' ' || w[i + 1] AS gram FROM docs, unnest(range(1, len(w))) u(i)) JOIN grams USING (gram)
),
rules AS (
  SELECT template, label, family, exact, alone, runs, least, n_grams, coalesce(list(place) FILTER (WHERE list_contains(needs, gram)), []) AS needed
  FROM grams GROUP BY ALL
),
diagonals AS (
  SELECT * REPLACE (CASE WHEN runs THEN {strong} ELSE places END AS places)
  FROM (SELECT row, template, diagonal, list(place) AS places FROM hits GROUP BY ALL) JOIN rules USING (template)
),
voting AS (SELECT * FROM diagonals WHERE len(places) > 0),
merging AS (
  SELECT d.row, d.template, d.label, d.family, d.exact, d.alone, d.least, d.needed, d.diagonal, len(d.places) AS own, d.n_grams,
         CASE WHEN d.alone THEN d.places ELSE list_distinct(flatten(list(o.places))) END AS merged
  FROM voting d JOIN voting o ON o.row = d.row AND o.template = d.template
    AND o.diagonal BETWEEN d.diagonal - {votes.slack} AND d.diagonal + {votes.slack}
  GROUP BY d.row, d.template, d.label, d.family, d.exact, d.alone, d.least, d.needed, d.diagonal, d.places, d.n_grams
),
shares AS (SELECT *, len(merged) / n_grams::double AS share FROM merging),
spans AS (
  SELECT s.*, len(merged) AS votes, greatest(diagonal + list_min(merged), 0) AS first, least(diagonal + list_max(merged) + 2, len(w)) AS last
  FROM shares s JOIN docs USING (row)
  WHERE share >= least AND list_has_all(merged, needed) AND (alone OR NOT EXISTS (
    SELECT 1 FROM shares o WHERE o.row = s.row AND o.template = s.template
      AND o.diagonal BETWEEN s.diagonal - {votes.slack} AND s.diagonal + {votes.slack}
      AND (o.share > s.share OR o.share = s.share AND (o.own > s.own OR o.own = s.own AND o.diagonal < s.diagonal))))
),
begun AS (
  SELECT *, CASE WHEN first < max(last) OVER (PARTITION BY row, family, exact ORDER BY first, last, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 THEN 0 ELSE 1 END AS new
  FROM spans
),
stretches AS (
  SELECT *, sum(new) OVER (PARTITION BY row, family, exact ORDER BY first, last, template ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stretch FROM begun
),
found AS (
  SELECT * FROM stretches
  QUALIFY exact OR rank() OVER (PARTITION BY row, family, exact, stretch ORDER BY votes DESC, share DESC, template) = 1
)
SELECT any_value(doc_id) AS doc_id, any_value(len(w))::bigint AS n_words, count(*) FILTER (WHERE exact) AS n_base,
       min(diagonal) FILTER (WHERE exact) AS first_word, max(diagonal) FILTER (WHERE exact) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0)::double AS score
FROM docs LEFT JOIN found USING (row) GROUP BY docs.row"""


def _warc() -> str:
    bits = "('0x' || substr(x, (5 * i) // 4 + 1, 2))::bigint >> (3 - (5 * i) % 4)"
    return f"""
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', (({bits}) & 31)::int + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, octet_length(encode(h))::bigint AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))"""


def _chat() -> str:
    said = "'</s>[INST] ok [/INST]'"
    size = "(length({0}) + length(regexp_replace({0}, '[^\\\\<\\[\\]]', '', 'g')))"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', {said}), (-1, 1, 'assistant', {said})
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0)::bigint AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       sum(9 + {size.format('r')} + {size.format('t')})::bigint AS formatted_chars
FROM turns GROUP BY conv_id"""


def _sharding() -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, octet_length(encode(coalesce(text, '')))::bigint AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || '-' || md5(coalesce(text, ''))), 1, 15))::bigint AS h
  FROM documents
),
sums AS (
  SELECT d, h >> (60 - d) AS p, sum(n_bytes)::bigint AS s, count(*) AS n FROM docs, range(0, 41) l(d) GROUP BY ALL
),
placed AS (
  SELECT row, doc_id, n_bytes, h, min(d) AS d FROM docs JOIN sums ON sums.p = h >> (60 - d)
  WHERE s <= {SHARD_BYTES} OR n = 1 GROUP BY ALL
)
SELECT doc_id, n_bytes, CASE WHEN placed.d = 0 THEN '' ELSE lpad(bin(p), placed.d::int, '0') END AS shard, placed.d::int AS depth,
       s AS shard_bytes, n AS shard_rows
FROM placed JOIN sums ON sums.d = placed.d AND sums.p = h >> (60 - placed.d)"""


def _vectors() -> str:
    return """
WITH RECURSIVE known AS (
  SELECT vec_id, label, embedding::double[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM known a JOIN known b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93::double
),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT e.vec_id, coalesce(n, 0)::bigint AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) ON a = e.vec_id
LEFT JOIN (SELECT links.a AS v, count(*) AS n FROM links GROUP BY 1) ON v = e.vec_id"""


def _quality() -> str:
    limits = RiskLimits()
    rejects = {
        "symbols": "1000 * n_symbols >= {c} * n_words", "repeats": "1000 * n_repeat_words >= {c} * n_words",
        "dup_lines": "n_dup_lines >= {c}", "long_words": "1000 * word_chars >= {c} * n_words", "short": "n_words < {c}",
    }
    grid = " UNION ALL ".join(
        f"SELECT *, '{rule}' AS rule, {rank} AS rank, {c} AS cutoff, {rejects[rule].format(c=c)} AS hit FROM used"
        for rule, values in limits.cutoffs.items()
        for rank, c in enumerate(values)
    )
    tail = (
        "(k <= n * {rate}::double AND list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)"
        " + j * ln({rate}::double) + (n - j) * ln(1 - {rate}::double)))) <= (SELECT {error}::double / count(*) FROM strata))"
    )
    passed = lambda n, k: tail.replace("lgamma(n", f"lgamma({n}").replace("(n - j)", f"({n} - j)").replace(
        "(k <= n", f"({k} <= {n}").replace("(0, k + 1)", f"(0, {k} + 1)").format(rate=limits.good_rejected, error=limits.error)
    verdict = " OR ".join(f"t.rule = '{rule}' AND {condition.format(c='t.cutoff')}" for rule, condition in rejects.items())
    rule_hits = " OR ".join(f"c.rule = '{rule}' AND {condition.format(c='c.cutoff')}" for rule, condition in rejects.items())
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w FROM documents
),
windows AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n
  FROM docs, unnest(range(1, len(w) - 3)) u(i)
),
repeats AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(0, 5) o(k) WHERE n > 1 GROUP BY 1
),
measured AS (
  SELECT row, doc_id, lang, md5(text) AS text_hash, len(w)::bigint AS n_words, length(array_to_string(w, ''))::bigint AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
         (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines, coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS l FROM docs)
  LEFT JOIN repeats USING (row)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
known AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING min(quality) = max(quality)
),
used AS (
  SELECT lang, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bool_and(good) AS good, text_hash >= '8' AS holdout
  FROM judged JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY ALL HAVING bool_and(good) = bool_or(good)
),
tuned AS (
  SELECT lang, rule, rank, cutoff, count(*) FILTER (WHERE good) AS gn, count(*) FILTER (WHERE good AND hit) AS gk,
         count(*) FILTER (WHERE NOT good) AS bn, count(*) FILTER (WHERE NOT good AND hit) AS bk
  FROM ({grid}) WHERE NOT holdout GROUP BY ALL
),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY bk DESC, gk, rule) AS place
  FROM (SELECT * FROM tuned
        WHERE bk > 0 AND bk * gn >= {limits.lift} * gk * bn AND gk <= gn * {limits.good_rejected / (2 * len(limits.cutoffs))}::double
        QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY bk DESC, rank DESC) = 1)
),
firsts AS (
  SELECT u.lang, u.good, u.holdout, (SELECT min(c.place) FROM chosen c WHERE c.lang IS NOT DISTINCT FROM u.lang AND ({rule_hits})) AS first
  FROM used u
),
depths AS (SELECT lang, place AS depth FROM chosen),
strata AS (SELECT DISTINCT lang FROM chosen),
counted AS (
  SELECT d.lang, d.depth, count(*) FILTER (WHERE good AND NOT holdout) AS gn, count(*) FILTER (WHERE good AND NOT holdout AND first <= depth) AS gk,
         count(*) FILTER (WHERE good AND holdout) AS n, count(*) FILTER (WHERE good AND holdout AND first <= depth) AS k,
         count(*) FILTER (WHERE NOT good AND NOT holdout AND first <= depth) AS bk
  FROM depths d JOIN firsts f ON f.lang IS NOT DISTINCT FROM d.lang GROUP BY ALL
),
best AS (
  SELECT * FROM counted WHERE {passed('gn', 'gk')} QUALIFY row_number() OVER (PARTITION BY lang ORDER BY bk DESC, depth) = 1
),
proven AS (
  SELECT c.lang, c.rule, c.cutoff FROM chosen c JOIN best b ON b.lang IS NOT DISTINCT FROM c.lang AND c.place <= b.depth WHERE {passed('b.n', 'b.k')}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM proven t WHERE t.lang IS NOT DISTINCT FROM j.lang AND ({verdict})) AS kept
FROM judged j"""


def _spelling() -> str:
    rule = Variants()
    # the checksum byte by byte, from its table of 256 entries
    entry = "list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
WITH RECURSIVE crc AS (SELECT list({entry} ORDER BY i) AS entries FROM range(0, 256) r(i)),
runs AS (
  SELECT coalesce(doc_id::varchar, 'null') AS d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
),
bytes AS (
  SELECT run, n, list_transform(range(0, octet_length(encode(d || ':' || run))), lambda i: ('0x' || substr(hex(encode(d || ':' || run)), 2 * i + 1, 2))::bigint) AS b
  FROM runs WHERE length(run) >= {rule.least_chars}
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
),
words AS (
  SELECT word, sum(n)::bigint AS n
  FROM (SELECT CASE WHEN h % {rule.drop} = 0 THEN left(run, (h % length(run))::int) || substr(run, (h % length(run) + 2)::int) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {rule.least_chars} GROUP BY 1 HAVING sum(n) >= {rule.least_count}
),
shorter AS (
  SELECT DISTINCT word, i, left(word, i::int - 1) || substr(word, i::int + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) u(i)
),
near AS (
  SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
),
best AS (
  SELECT a AS word, count(*) AS n_near, (arg_min(struct_pack(b := b, n := w.n), struct_pack(n := -w.n, b := b))) AS o
  FROM near JOIN words w ON w.word = b GROUP BY 1
),
forms AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN o.n >= {rule.ratio} * w.n THEN o.b END AS form, CASE WHEN o.n >= {rule.ratio} * w.n THEN o.n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
followed(word, last) AS (SELECT word, word FROM forms UNION ALL SELECT f.word, forms.form FROM followed f JOIN forms ON forms.word = f.last WHERE forms.form IS NOT NULL)
SELECT word, form, last AS root, n, n_near, form_n
FROM forms JOIN (SELECT f.word, f.last FROM followed f JOIN forms ON forms.word = f.last WHERE forms.form IS NULL) USING (word)"""


def _fim() -> str:
    fim = Fim()
    marks = [m.decode() for m in (fim.prefix, fim.suffix, fim.middle)]
    held = " OR ".join(f"contains(t, '{m}')" for m in marks)
    part = "coalesce(array_to_string(u[{} : {}], ''), '')"
    h = lambda i: f"('0x' || substr(sha256('{fim.seed}:' || coalesce(doc_id::varchar, 'null')), {8 * i + 1}, 8))::bigint"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         {h(0)} AS h1, {h(1)} AS h2, {h(2)} AS h3, {h(3)} AS h4 FROM documents
),
cut AS (
  SELECT *, len(u)::bigint AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR {held} OR h3 % 100 >= {fim.share} THEN 'plain' WHEN h4 % 100 < {fim.spm} THEN 'spm' ELSE 'psm' END AS form
  FROM docs
),
parts AS (
  SELECT *, {part.format('1', 'a')} AS p, {part.format('a + 1', 'b')} AS m, {part.format('b + 1', 'n')} AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{marks[0]}' || p || '{marks[1]}' || s || '{marks[2]}' || m
                        WHEN 'spm' THEN '{marks[1]}' || s || '{marks[0]}' || p || '{marks[2]}' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""


STATEMENTS: dict[str, str] = {
    "op1_mixing": _mixing(),
    "op2_licences": _licences(),
    "op3_warc": _warc(),
    "op5_chat": _chat(),
    "op6_sharding": _sharding(),
    "op7_vectors": _vectors(),
    "op9_quality_rules": _quality(),
    "op11_spelling": _spelling(),
    "op13_fill_in_middle": _fim(),
}
