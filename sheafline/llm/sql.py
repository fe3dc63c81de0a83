"""The queries as DuckDB SQL, written from their definitions and not from the operators."""

from __future__ import annotations

from .chat import ASSISTANT, BLOCK_TURNS, NOBODY, START, USER
from .licenses import PHRASES, TEMPLATES, THRESHOLD
from .url_filter import RULES, SOFT, SOFT_LIMIT, STRICT


def url_filter() -> str:
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in RULES)
    terms = ", ".join([*(f"('{t}', 0)" for t in STRICT), *(f"('{t}', {w})" for t, w in SOFT.items())])
    return f"""
WITH rules(verdict, rule, site, front) AS (VALUES {rules}),
terms(term, weight) AS (VALUES {terms}),
parts AS (
    SELECT page_id, lower(coalesce(url, '')) AS low,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
hits AS (
    SELECT page_id, term, weight FROM parts, terms
    WHERE regexp_matches(low, '(^|[^\\pL\\pN])' || term || '($|[^\\pL\\pN])')),
found AS (
    SELECT page_id, coalesce(string_agg(DISTINCT term, ',' ORDER BY term) FILTER (WHERE weight = 0), '') AS strict_terms,
           coalesce(string_agg(DISTINCT term, ',' ORDER BY term) FILTER (WHERE weight > 0), '') AS soft_terms,
           sum(weight)::BIGINT AS soft_weight
    FROM hits GROUP BY page_id),
fits AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, front) GROUP BY page_id)
SELECT p.page_id, host, path, rule,
       coalesce(f.verdict, CASE WHEN coalesce(strict_terms, '') <> '' OR coalesce(soft_weight, 0) >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(strict_terms, '') AS strict_terms, coalesce(soft_terms, '') AS soft_terms, coalesce(soft_weight, 0) AS soft_weight
FROM parts p LEFT JOIN fits f USING (page_id) LEFT JOIN found t USING (page_id)"""


#: The words of a text as a list.
WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '')"


def substring_dedup(length: int = 50) -> str:
    return f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(len(words) - {length - 1})) AS place FROM docs),
windows AS (SELECT doc_id, place, array_to_string(words[place + 1 : place + {length}], ' ') AS seq FROM starts),
firsts AS (SELECT seq, min(doc_id) AS first FROM windows GROUP BY seq),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(place, place + {length})) AS place
    FROM windows JOIN firsts USING (seq) WHERE doc_id > first),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


#: A-Z to a-z and nothing else.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def ngram_jaccard_join(length: int = 4, num: int = 85, den: int = 100) -> str:
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER)} AS words FROM documents),
grams AS (
    SELECT DISTINCT doc_id, hash(array_to_string(words[place + 1 : place + {length}], ' ')) AS gram
    FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - {length - 1}, least(len(words), 1)))) AS place FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n_both
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT one, two FROM shared JOIN sizes x ON one = x.doc_id JOIN sizes y ON two = y.doc_id
    WHERE {den} * n_both >= {num} * (x.n + y.n - n_both)),
steps AS (SELECT one, two FROM links UNION ALL SELECT two, one FROM links),
reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, s.two FROM reach r JOIN steps s ON r.seen = s.one)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""


def chat_perspectives() -> str:
    return f"""
WITH rows AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '{NOBODY}') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (
    SELECT *, coalesce(turn // {BLOCK_TURNS}, -1) AS block,
           (row_number() OVER (PARTITION BY conv_id, turn // {BLOCK_TURNS} ORDER BY turn NULLS FIRST, role, text) - 1) // {BLOCK_TURNS} AS part
    FROM rows),
people AS (SELECT DISTINCT conv_id, role AS participant FROM rows),
said AS (
    SELECT p.*, participant, role = participant AS own,
           CASE WHEN role = participant THEN '{START}{ASSISTANT}' ELSE '{START}{USER} name=' || role END || chr(10) AS head,
           head || text || '<|im_end|>' || chr(10) AS line
    FROM placed p JOIN people q ON p.conv_id IS NOT DISTINCT FROM q.conv_id),
ends AS (
    SELECT *, sum(length(line)) OVER (PARTITION BY conv_id, participant, block, part ORDER BY turn NULLS FIRST, role, text) AS stop FROM said)
SELECT conv_id, participant, block, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
       string_agg(line, '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg((stop - length(line) + length(head))::VARCHAR || '-' || stop::VARCHAR, ',' ORDER BY turn NULLS FIRST, role, text)
                FILTER (WHERE own), '') AS mask
FROM ends GROUP BY ALL"""


def license_scan() -> str:
    words = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    hits = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(words)), lambda i: "
        + " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        + ")) AS place FROM docs"
        for phrase, label in PHRASES.items()
    )
    templates = ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES)
    lower = LOWER.replace("coalesce(text, '')", "{}")
    return f"""
WITH docs AS (SELECT doc_id, {words.format(LOWER)} AS words FROM documents),
hits AS ({hits}),
base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM hits GROUP BY doc_id),
templates AS (
    SELECT label, {words.format(lower.format("text"))} AS all_words, list_distinct(all_words) AS template, len(template) AS size
    FROM (VALUES {templates}) AS t(label, text)),
maybe AS (
    SELECT doc_id, words, label, len(all_words) AS span, template, size FROM docs, templates
    WHERE {THRESHOLD[1]} * len(list_intersect(words, template)) >= {THRESHOLD[0]} * size),
windows AS (
    SELECT doc_id, label, size, template, words[place + 1 : place + span] AS held FROM (SELECT *, unnest(range(len(words))) AS place FROM maybe)),
found AS (
    SELECT doc_id, label, size, len(list_intersect(held, template)) AS n FROM windows
    WHERE {THRESHOLD[1]} * len(list_intersect(held, template)) >= {THRESHOLD[0]} * size),
best AS (SELECT doc_id, max(n / size) AS containment, list(DISTINCT label) AS found FROM found GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


def decontamination(length: int = 5) -> str:
    words = "regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN]+')"
    return f"""
WITH docs AS (SELECT doc_id, {words} AS words FROM documents),
items AS (SELECT item_id, {words} AS words FROM benchmark),
doc_places AS (SELECT doc_id, len(words) AS n, words, unnest(range(len(words) - {length - 1})) AS place FROM docs),
doc_grams AS (SELECT doc_id, n, place, array_to_string(words[place + 1 : place + {length}], ' ') AS gram FROM doc_places),
item_places AS (SELECT item_id, len(words) AS size, words, unnest(range(len(words) - {length - 1})) AS place FROM items),
item_grams AS (
    SELECT item_id, size, array_to_string(words[place + 1 : place + {length}], ' ') AS gram, count(*) AS c FROM item_places GROUP BY ALL),
starts AS (
    SELECT DISTINCT doc_id, n, size, greatest(0, least(place, n - size)) AS start
    FROM doc_grams JOIN (SELECT DISTINCT gram, size FROM item_grams) USING (gram)),
windows AS (
    SELECT s.doc_id, s.n, size, start, gram, count(*) AS c FROM starts s JOIN doc_grams g ON s.doc_id = g.doc_id
    WHERE place >= start AND place <= start + least(size, s.n) - {length} GROUP BY ALL),
pairs AS (
    SELECT doc_id, item_id, start, sum(least(w.c, i.c)) AS n_both, least(any_value(n), any_value(size)) + any_value(size) - {2 * (length - 1)} AS n_sum
    FROM windows w JOIN item_grams i USING (size, gram) GROUP BY doc_id, item_id, start),
found AS (SELECT *, n_both / (n_sum - n_both) AS similarity FROM pairs WHERE 10 * n_both >= 8 * (n_sum - n_both))
SELECT doc_id, item_id, arg_max(start, (similarity, -start))::BIGINT AS start, max(similarity)::DOUBLE AS similarity
FROM found GROUP BY doc_id, item_id"""


def lm_scores(backoff: float = 0.4) -> str:
    return f"""
WITH docs AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER)} AS words FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs),
pairs AS (
    SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM tokens),
own1 AS (SELECT doc_id, word, count(*) AS c FROM tokens GROUP BY ALL),
all1 AS (SELECT word, sum(c) AS c FROM own1 GROUP BY ALL),
own2 AS (SELECT doc_id, before, word, count(*) AS c FROM pairs WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, word, sum(c) AS c FROM own2 GROUP BY ALL),
others AS (
    SELECT p.doc_id, p.place, a1.c - o1.c AS c1, b1.c - q1.c AS c0, a2.c - o2.c AS c2
    FROM pairs p JOIN own1 o1 USING (doc_id, word) JOIN all1 a1 USING (word)
    LEFT JOIN own1 q1 ON p.doc_id = q1.doc_id AND p.before = q1.word LEFT JOIN all1 b1 ON p.before = b1.word
    LEFT JOIN own2 o2 ON p.doc_id = o2.doc_id AND p.before = o2.before AND p.word = o2.word
    LEFT JOIN all2 a2 ON p.before = a2.before AND p.word = a2.word),
scores AS (
    SELECT doc_id, count(*) FILTER (WHERE c1 = 0) AS n_unseen,
           sum(CASE WHEN c2 > 0 AND c0 > 0 THEN ln(c2) - ln(c0)
                    ELSE CASE WHEN place > 0 THEN ln({backoff}) ELSE 0 END + ln(greatest(c1, 1))
                         - ln(greatest((SELECT count(*) FROM tokens) - n, 1)) END) AS log_score
    FROM others JOIN (SELECT doc_id, len(words) AS n FROM docs) USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_unseen, 0) AS n_unseen, round(coalesce(log_score, 0), 4)::DOUBLE AS log_score,
       CASE WHEN len(words) > 0 THEN round(log_score / len(words), 4)::DOUBLE END AS mean_log_score
FROM docs LEFT JOIN scores USING (doc_id)"""


#: CRC-32 (unsigned) of the decimal doc_id, bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, _: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def merkle_manifest(arity: int = 8, levels: int = 9, group_levels: int = 3) -> str:
    """``levels`` and ``group_levels`` bound the trees' heights: arity ** levels leaves at most."""

    def framed(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields)

    def tree(name: str, leaves: str, height: int) -> str:
        """name_l: the nodes of level l; a finished tree's root is carried on."""
        out = [f"{name}_0 AS ({leaves})"]
        for at in range(height):
            out.append(f"""{name}_{at + 1} AS (
    SELECT tree, CASE WHEN n = 1 THEN i ELSE i // {arity} END AS i, CASE WHEN n = 1 THEN 1 ELSE (n + {arity - 1}) // {arity} END AS n,
           CASE WHEN n = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY p.i)) END AS hash
    FROM {name}_{at} p GROUP BY tree, n, CASE WHEN n = 1 THEN p.i ELSE p.i // {arity} END)""".replace("THEN i ELSE i //", "THEN p.i ELSE p.i //"))
        return ",\n".join(out)

    def fold(name: str, start: str, base: str, height: int) -> str:
        """name_l: per row of ``start`` (id, tree, i, hash, proof) the fold up to level l of the tree ``base``."""
        out = [f"{name}_0 AS ({start})"]
        for at in range(height):
            out.append(f"""{name}_{at + 1} AS (
    SELECT r.id, r.tree, any_value(CASE WHEN n = 1 THEN r.i ELSE r.i // {arity} END) AS i,
           CASE WHEN any_value(n) = 1 THEN any_value(r.hash)
                ELSE sha256(string_agg(CASE WHEN s.i = r.i THEN r.hash ELSE s.hash END, '' ORDER BY s.i)) END AS hash,
           any_value(r.proof) || CASE WHEN any_value(n) = 1 THEN '' ELSE coalesce(string_agg(s.hash, '' ORDER BY s.i) FILTER (WHERE s.i <> r.i), '') END AS proof
    FROM {name}_{at} r JOIN {base}_{at} s ON r.tree = s.tree AND r.i // {arity} = s.i // {arity} GROUP BY r.id, r.tree)""")
        return ",\n".join(out)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hashed = f"""
    SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS tree, sha256({framed("text")}) AS leaf,
           CASE WHEN {CRC} % 3 = 0 THEN sha256({framed(lower)}) ELSE sha256({framed("text")}) END AS told FROM documents"""
    return f"""
WITH hashed AS MATERIALIZED ({hashed}),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{tree("nodes", "SELECT tree, i, n, leaf AS hash FROM placed", levels)},
subroots AS MATERIALIZED (
    SELECT tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes_{levels}),
{tree("high", "SELECT '' AS tree, i, n, hash FROM subroots", group_levels)},
{fold("low", "SELECT id, tree, i, told AS hash, '' AS proof FROM placed", "nodes", levels)},
{fold("top", f"SELECT id, '' AS tree, s.i, l.hash, proof FROM low_{levels} l JOIN subroots s ON l.tree = s.name", "high", group_levels)}
SELECT doc_id, leaf, s.hash AS subroot, h.hash AS root, sha256(t.proof) AS proof_sha256, t.hash AS folded_root, t.hash = h.hash AS verified
FROM placed p JOIN subroots s ON p.tree = s.name JOIN top_{group_levels} t USING (id) JOIN high_{group_levels} h ON true"""


def periodic_runs(least: int = 24, times: int = 3, length: int = 16) -> str:
    """A run has ``length`` words in a row that stand again one period later: all pairs of equal windows of that length."""
    return f"""
WITH docs AS (SELECT doc_id, {CRC} AS h, h // 10 AS g, {WORDS} AS words FROM documents),
cuts AS (
    SELECT doc_id, words, len(words) AS n, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, 1 + (n - a) // (3 + g % 8) AS p FROM docs),
planted AS MATERIALIZED (
    SELECT doc_id, CASE WHEN a IS NULL THEN words ELSE list_concat(words[: a], flatten(list_transform(range(10), lambda _: words[a + 1 : a + p]))[: n - a]) END AS words
    FROM cuts),
windows AS (
    SELECT doc_id, place, hash(array_to_string(words[place + 1 : place + {length}], ' ')) AS seq
    FROM (SELECT doc_id, words, unnest(range(len(words) - {length - 1})) AS place FROM planted)),
pairs AS (SELECT x.doc_id, x.place, y.place - x.place AS period FROM windows x JOIN windows y ON x.doc_id = y.doc_id AND x.seq = y.seq AND x.place < y.place),
islands AS (
    SELECT *, place - row_number() OVER (PARTITION BY doc_id, period ORDER BY place) AS island FROM pairs),
stretches AS (
    SELECT doc_id, period, min(place) AS start, max(place) - min(place) + {length} + period AS length FROM islands GROUP BY doc_id, period, island),
runs AS MATERIALIZED (
    SELECT doc_id, start, length, period FROM stretches s WHERE length >= greatest({least}, {times} * period) AND NOT EXISTS (
        FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
           arg_max({{'start': start, 'length': length, 'period': period}}, (length::DOUBLE / period, -start, -period)) AS best
    FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM runs),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM planted),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
