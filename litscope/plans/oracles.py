"""The registered queries in plain SQL, for an independent engine to check."""

from __future__ import annotations

from litscope.functions.stem import STEP_2, STEP_3, STEP_4
from litscope.functions.text import PHRASE_TOKEN, SIMPLE_WORD
from litscope.functions.words import (
    PHRASE_STOP_WORDS,
    PUNCTUATION,
    SEARCH_STOP_WORDS,
    TREND_BLOCK_LIST,
)


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_STOP = _quoted(SEARCH_STOP_WORDS)
_IGNORED = _quoted(PHRASE_STOP_WORDS + PUNCTUATION)

_CORPUS = """
corpus AS (
  SELECT doc_id, 'article' AS type, concat('conf/', source, '/D', doc_id) AS key, text AS title,
         source AS booktitle, CAST(2014 + (doc_id // 20) % 5 AS INTEGER) AS year,
         [concat('a', doc_id % 37), concat('b', doc_id % 101)] AS author
  FROM documents)"""


def _tokens(*fields: str) -> str:
    text = {"author": "array_to_string(author, chr(10))"}
    parts = " UNION ALL ".join(
        f"SELECT doc_id, year, '{f}' AS field, "
        f"regexp_extract_all(lower({text.get(f, f)}), '{SIMPLE_WORD}') AS w FROM corpus"
        for f in fields
    )
    return f"""{_CORPUS},
words AS ({parts}),
listed AS (SELECT doc_id, year, field, unnest(w) AS term, unnest(range(len(w))) AS pos FROM words),
tok AS (SELECT doc_id, year, field, term, CAST(pos AS INTEGER) AS pos FROM listed WHERE term NOT IN ({_STOP})),
dl AS (SELECT field, doc_id, year, CAST(count(*) AS INTEGER) AS length FROM tok GROUP BY ALL),
fs AS (SELECT field, count(*) AS docs, CAST(sum(length) AS BIGINT) AS tokens, avg(length) AS mean_length
       FROM dl GROUP BY field),
tf AS (SELECT field, term, doc_id, CAST(count(*) AS INTEGER) AS tf, list(pos ORDER BY pos) AS positions
       FROM tok GROUP BY field, term, doc_id),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY field, term)"""


_FIELDS = ("title", "author", "key", "booktitle")

_RANK = """
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM answer)
{limit}"""

# Clauses (query_id, grp, occur, clause, term, off, size, boost) -> answer.
# A clause hits a document where all its terms stand at start + offset.
_SEARCH = """
idf AS (SELECT c.*, f.mean_length,
               ln(1 + (f.docs - d.df + 0.5) / (d.df + 0.5)) AS idf
        FROM clauses c JOIN fs f USING (field) JOIN df d USING (field, term)),
weight AS (SELECT query_id, clause, any_value(boost) * sum(idf) AS weight FROM idf GROUP BY ALL
           HAVING count(*) = any_value(size)),
starts AS (SELECT i.query_id, i.grp, i.occur, i.clause, i.field, i.mean_length, t.doc_id, t.pos - i.off AS start
           FROM idf i JOIN tok t USING (field, term)
           GROUP BY ALL HAVING count(*) = any_value(i.size)),
freq AS (SELECT query_id, grp, occur, clause, field, mean_length, doc_id, count(*) AS tf FROM starts GROUP BY ALL),
part AS (SELECT f.query_id, f.grp, f.occur, f.clause, f.doc_id,
                w.weight * f.tf / (f.tf + 1.2 * (1 - 0.75 + 0.75 * d.length / f.mean_length)) AS part
         FROM freq f JOIN weight w USING (query_id, clause) JOIN dl d USING (field, doc_id)),
need AS (SELECT query_id, grp, count(DISTINCT clause) FILTER (WHERE occur = 'must') AS musts
         FROM clauses GROUP BY ALL),
grouped AS (SELECT query_id, grp, doc_id, count(*) FILTER (WHERE occur = 'must') AS met,
                   count(*) FILTER (WHERE occur = 'should') AS extra,
                   count(*) FILTER (WHERE occur = 'must_not') AS barred,
                   coalesce(sum(part) FILTER (WHERE occur <> 'must_not'), 0) AS score
            FROM part GROUP BY ALL),
held AS (SELECT g.* FROM grouped g JOIN need n USING (query_id, grp)
         WHERE g.met = n.musts AND g.barred = 0 AND (n.musts > 0 OR g.extra > 0)),
answer AS (SELECT h.query_id, h.doc_id, round(sum(h.score){constant}, 9) AS score
           FROM held h JOIN corpus c USING (doc_id) WHERE {years}
           GROUP BY h.query_id, h.doc_id
           HAVING count(*) = any_value((SELECT count(*) FROM need n WHERE n.query_id = h.query_id)))"""


def _search(clauses: str, limit: str = "WHERE rank <= 20", constant: str = "", years: str = "true", with_: str = "WITH") -> str:
    body = _SEARCH.format(constant=constant, years=years)
    return f"{with_} {_tokens(*_FIELDS)},\n{clauses},{body}{_RANK.format(limit=limit)}"


def _values(*rows: tuple) -> str:
    """Rows of (grp, occur, clause, field, term, off, size[, boost])."""
    listed = ", ".join(
        "('q', {}, '{}', '{}', '{}', '{}', {}, {}, {})".format(*(r if len(r) == 8 else (*r, 1.0))) for r in rows
    )
    return f"clauses(query_id, grp, occur, clause, field, term, off, size, boost) AS (VALUES {listed})"


def _single(occur: str, *terms: str, field: str = "title", grp: int = 0) -> list[tuple]:
    return [(grp, occur, f"{field}{i}", field, t, 0, 1) for i, t in enumerate(terms)]


def _phrase(clause: str, *placed: tuple[str, int]) -> list[tuple]:
    return [(0, "must", clause, "title", t, off, len(placed)) for t, off in placed]


def _venue(*tokens: str, raw: str) -> list[tuple]:
    return [
        (2, "should", "key", "key", raw, 0, 1),
        *_single("should", *tokens, field="booktitle", grp=2),
    ]


_BENCHMARK_WORDS = f"""
bw AS (SELECT CAST(item_id AS VARCHAR) AS query_id, regexp_extract_all(lower(text), '{SIMPLE_WORD}') AS w FROM benchmark),
bt AS (SELECT query_id, unnest(w) AS term, unnest(range(len(w))) AS off FROM bw),
clauses AS (SELECT query_id, 0 AS grp, 'should' AS occur, CAST(off AS VARCHAR) AS clause, 'title' AS field, term,
                   0 AS off, 1 AS size, 1.0 AS boost
            FROM bt WHERE term NOT IN ({_STOP}))"""

_BENCHMARK_KEYWORDS = f"""
marked AS (SELECT CAST(item_id AS VARCHAR) AS query_id,
                  regexp_replace(text, '(?i)( AND | OR | NOT |, )', chr(1) || '\\1' || chr(2), 'g') AS text
           FROM benchmark),
split AS (SELECT query_id, unnest(string_split(text, chr(1))) AS piece,
                 unnest(range(len(string_split(text, chr(1))))) AS clause FROM marked),
linked AS (SELECT query_id, clause,
                  CASE WHEN contains(piece, chr(2)) THEN upper(trim(string_split(piece, chr(2))[1])) ELSE '' END AS link,
                  string_split(piece, chr(2))[-1] AS text FROM split),
kw AS (SELECT query_id, CAST(clause AS VARCHAR) AS clause,
              CASE WHEN link IN ('OR', ',') THEN 'should' WHEN link = 'NOT' THEN 'must_not' ELSE 'must' END AS occur,
              regexp_extract_all(lower(text), '{SIMPLE_WORD}') AS w FROM linked),
kt AS (SELECT query_id, clause, occur, unnest(w) AS term, unnest(range(len(w))) AS pos FROM kw),
kept AS (SELECT * FROM kt WHERE term NOT IN ({_STOP})),
clauses AS (SELECT query_id, 0 AS grp, occur, clause, 'title' AS field, term,
                   pos - min(pos) OVER (PARTITION BY query_id, clause) AS off,
                   count(*) OVER (PARTITION BY query_id, clause) AS size, 1.0 AS boost FROM kept)"""


def _patterns(*conditions: str) -> str:
    """Constant score 1 per pattern; all patterns must hold."""
    seen = " UNION ALL ".join(
        f"SELECT DISTINCT doc_id, {i} AS clause FROM tf WHERE field = 'title' AND {c}" for i, c in enumerate(conditions)
    )
    return (
        f"WITH {_tokens('title')}, seen AS ({seen}), answer AS (SELECT 'q' AS query_id, doc_id, "
        f"CAST(count(*) AS DOUBLE) AS score FROM seen GROUP BY doc_id HAVING count(*) = {len(conditions)})"
        + _RANK.format(limit="WHERE rank <= 20")
    )


# Edits with swaps, no letter edited twice: the table of distances, cell by cell, of
# the pairs that the engine's own distance, which counts bytes, leaves. From ``asked``
# (query_id, text, edits) to ``near`` (query_id, term, weight).
_FUZZY = """
pairs AS (SELECT DISTINCT term AS a, text AS b FROM (SELECT DISTINCT term FROM df WHERE field = 'title'), asked
          WHERE abs(length(term) - length(text)) <= edits AND damerau_levenshtein(term, text) <= 4 * edits),
cells AS (
  SELECT a, b, 0 AS k, [0] AS d FROM pairs
  UNION ALL
  SELECT a, b, k + 1, list_append(d, CASE WHEN i = 0 THEN j WHEN j = 0 THEN i ELSE least(
      d[(i - 1) * w + j + 1] + 1, d[i * w + j] + 1, d[(i - 1) * w + j] + CASE WHEN a[i] = b[j] THEN 0 ELSE 1 END,
      CASE WHEN i > 1 AND j > 1 AND a[i] = b[j - 1] AND a[i - 1] = b[j] THEN d[(i - 2) * w + j - 1] + 1 ELSE 1000 END) END)
  FROM (SELECT *, length(b) + 1 AS w, CAST((k + 1) // (length(b) + 1) AS BIGINT) AS i, CAST((k + 1) % (length(b) + 1) AS BIGINT) AS j
        FROM cells WHERE k + 1 < (length(a) + 1) * (length(b) + 1))),
distances AS (SELECT a, b, list_last(d) AS apart FROM cells WHERE k + 1 = (length(a) + 1) * (length(b) + 1)),
near AS (SELECT query_id, a AS term, greatest(0, 1 - apart / greatest(1, least(length(a), length(b)))) AS weight
         FROM asked JOIN distances ON text = b WHERE apart <= edits)"""

def _distances(least: str) -> str:
    """From ``pairs``, those of ``vocabulary`` and ``asked`` that plain letters' own distance leaves, to ``distances``.

    That distance is never above the exact one; it counts the bytes of other letters
    one by one, so those words get four times the room.
    """
    cells = _FUZZY.strip()
    cells = cells[cells.index("cells AS") : cells.index("near AS")].rstrip().rstrip(",")
    return f"""pairs AS (SELECT DISTINCT term AS a, word AS b FROM vocabulary, asked WHERE abs(length(term) - length(word)) <= {least}
          AND damerau_levenshtein(term, word) <= CASE WHEN strlen(term) = length(term) AND strlen(word) = length(word) THEN {least} ELSE 4 * {least} END),
{cells}"""


_PATTERN_BATCH = f"""
bw AS (SELECT CAST(item_id AS VARCHAR) AS query_id, regexp_extract_all(lower(text), '{SIMPLE_WORD}') AS w FROM benchmark),
bp AS (SELECT query_id, unnest(w) AS word, unnest(range(len(w))) AS clause FROM bw),
asked AS (SELECT * FROM bp WHERE clause % 5 = 2),
vocabulary AS (SELECT DISTINCT term FROM df WHERE field = 'title'),
{_distances("1")},
met AS (SELECT query_id, clause, a AS term, greatest(0, 1 - apart / greatest(1, least(length(a), length(b)))) AS weight
        FROM asked JOIN distances ON word = b WHERE apart <= 1
  UNION ALL SELECT query_id, clause, term, 1 FROM bp JOIN vocabulary ON starts_with(term, substr(word, 1, 4)) WHERE clause % 5 = 0
  UNION ALL SELECT query_id, clause, term, 1 FROM bp JOIN vocabulary
            ON starts_with(term, substr(word, 1, 2)) AND length(term) >= length(substr(word, 1, 2)) + 2 AND ends_with(term, right(word, 1)) WHERE clause % 5 = 1
  UNION ALL SELECT query_id, clause, term, 1 FROM bp JOIN vocabulary
            ON term BETWEEN substr(word, 1, 3) AND substr(word, 1, 3) || 'c' WHERE clause % 5 = 3
  UNION ALL SELECT query_id, clause, term, 1 FROM bp JOIN vocabulary
            ON regexp_full_match(term, substr(word, 1, 2) || '(th|er)+') WHERE clause % 5 = 4),
parts AS (SELECT query_id, clause, doc_id, max(weight) AS part FROM met JOIN tf USING (term) WHERE field = 'title' GROUP BY ALL),
answer AS (SELECT query_id, doc_id, round(sum(part), 9) AS score FROM parts GROUP BY ALL)"""

_BENCHMARK_VOCABULARY = f"""
asked AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{SIMPLE_WORD}')) AS word FROM benchmark),
vocabulary AS (SELECT term FROM df WHERE field = 'title')"""

_FUZZY_WORDS = f"{_BENCHMARK_VOCABULARY.strip()},\n{_distances('2')}"

_THREE_MUSTS = f"""
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS query_id, unnest(regexp_extract_all(lower(text), '{SIMPLE_WORD}')) AS term FROM benchmark),
rated AS (SELECT query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY df, term) - 1 AS place,
                 count(*) OVER (PARTITION BY query_id) AS n FROM bw JOIN df USING (term) WHERE field = 'title'),
clauses AS (SELECT query_id, 0 AS grp, 'must' AS occur, CAST(place AS VARCHAR) AS clause, 'title' AS field, term, 0 AS off, 1 AS size, 1.0 AS boost
            FROM rated WHERE place IN (0, (n - 1) // 2, n - 1))"""

_BLOCKED = " OR ".join(f"contains(phrase, '{b}')" for b in TREND_BLOCK_LIST)

_RUNS = f"""list_filter(list_transform(string_split(array_to_string(list_transform(
    regexp_extract_all(title, '{PHRASE_TOKEN}'),
    lambda t: CASE WHEN lower(t) IN ({_IGNORED}) THEN chr(10) ELSE lower(t) END), ' '), chr(10)),
    lambda r: trim(r)), lambda r: length(r) > 0 AND len(string_split(r, ' ')) BETWEEN 2 AND 4)"""

_COUNTS = f"""{_CORPUS},
counts AS (SELECT venue, year, phrase, count(*) AS n FROM (
             SELECT booktitle AS venue, year, unnest({_RUNS}) AS phrase FROM corpus WHERE year BETWEEN 2014 AND 2018)
           GROUP BY ALL)"""


def _scored(scope: str, counts: str, name: str) -> str:
    """Word and phrase scores of a count table, per scope."""
    return f"""
{name}_each AS (SELECT {scope}, phrase, n, unnest(string_split(phrase, ' ')) AS word,
                       unnest(range(len(string_split(phrase, ' ')))) AS place, len(string_split(phrase, ' ')) AS length
                FROM {counts}),
{name}_words AS (SELECT {scope}, word, CAST(sum(n * length) AS BIGINT) AS degree, CAST(sum(n) AS BIGINT) AS freq,
                        CAST(sum(n * length) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS word_score
                 FROM {name}_each GROUP BY {scope}, word),
{name}_phrases AS (SELECT {scope}, phrase, n, list_reduce(list(word_score ORDER BY place), lambda a, b: a + b) AS score
                   FROM {name}_each JOIN {name}_words USING ({scope}, word) GROUP BY {scope}, phrase, n)"""


def _leaders(scope: str, phrases: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT {scope}, phrase, n, score, CAST(row_number() OVER (
      PARTITION BY {scope} ORDER BY n DESC, score DESC, phrase DESC) AS INTEGER) AS rank
      FROM {phrases} WHERE NOT ({_BLOCKED})) WHERE rank <= {k}"""


_SPAN = "span AS (SELECT venue, phrase, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL)"

_SHOW = "SELECT venue, year, phrase, n, round(score, 6) AS score, rank FROM"


_TOPICS = ("eriner thanea", "heed thhend")

_PLAIN = "regexp_replace(lower(regexp_replace({}, '[\\x{{80}}-\\x{{ff}}]', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"

# Token-set ratio: the longest common subsequence of the two remainders is found
# with one bit for each character of the first, character by character of the second.
# A ratio counts from 79.5, which rounds to the even 80.
_FUZZY_TOPICS = f"""
listed AS (SELECT doc_id, unnest({_RUNS}) AS phrase FROM corpus WHERE year BETWEEN 2014 AND 2018),
pairs AS (SELECT phrase, topic, list_distinct(list_filter(string_split({_PLAIN.format('phrase')}, ' '), lambda w: w <> '')) AS a,
                 list_distinct(string_split(topic, ' ')) AS b
          FROM (SELECT DISTINCT phrase FROM listed), (VALUES {', '.join(f"('{t}')" for t in _TOPICS)}) AS t(topic)),
parts AS (SELECT phrase, topic, array_to_string(list_sort(list_intersect(a, b)), ' ') AS shared,
                 array_to_string(list_sort(list_filter(a, lambda w: NOT list_contains(b, w))), ' ') AS x,
                 array_to_string(list_sort(list_filter(b, lambda w: NOT list_contains(a, w))), ' ') AS y FROM pairs WHERE len(a) > 0),
bits AS (SELECT *, (CAST(1 AS HUGEINT) << length(x)) - 1 AS whole, list_transform(range(1, length(y) + 1), lambda j: coalesce(
           list_sum(list_transform(range(0, length(x)), lambda i: CASE WHEN x[i + 1] = y[j] THEN CAST(1 AS HUGEINT) << CAST(i AS INTEGER)
             ELSE CAST(0 AS HUGEINT) END)), 0)) AS places FROM parts),
common AS (SELECT *, length(x) - bit_count(list_reduce(list_prepend(whole, list_transform(places, lambda m: CAST(m AS HUGEINT))),
             lambda r, m: ((r + (r & m)) | (r - (r & m))) & whole)) AS lcs,
             CASE WHEN shared = '' THEN 0 ELSE length(shared) + 1 END AS joint FROM bits),
good AS (SELECT phrase, topic FROM common WHERE CASE
           WHEN shared <> '' AND (x = '' OR y = '') THEN 100
           WHEN shared <> '' THEN greatest(
             100 - 100.0 * (length(x) + length(y) - 2 * lcs) / (2 * joint + length(x) + length(y)),
             100 - 100.0 * (1 + length(x)) / (length(shared) + joint + length(x)),
             100 - 100.0 * (1 + length(y)) / (length(shared) + joint + length(y)))
           ELSE 100 - 100.0 * (length(x) + length(y) - 2 * lcs) / (length(x) + length(y)) END >= 79.5)"""


def _topic_authors() -> str:
    """Pairs that share a word, or whose plain distance, never above that of the subsequence, leaves room for a match."""
    sets = "list_sort(list_distinct(list_filter(string_split({}, ' '), lambda w: w <> '')))"
    tail = _FUZZY_TOPICS[_FUZZY_TOPICS.index("parts AS") :].replace("phrase, topic", "p, t")
    topics = _RUNS.replace("regexp_extract_all(title", "regexp_extract_all(text")
    return f"""WITH {_CORPUS},
listed AS (SELECT doc_id, unnest({_RUNS}) AS phrase FROM corpus WHERE year BETWEEN 2014 AND 2018),
phrases AS (SELECT phrase, {sets.format(_PLAIN.format('phrase'))} AS a FROM (SELECT DISTINCT phrase FROM listed)),
topics AS (SELECT topic, {sets.format(_PLAIN.format('topic'))} AS b FROM (SELECT DISTINCT unnest({topics}) AS topic FROM benchmark)),
ps AS (SELECT DISTINCT a, array_to_string(a, ' ') AS p FROM phrases WHERE len(a) > 0),
ts AS (SELECT DISTINCT b, array_to_string(b, ' ') AS t FROM topics WHERE len(b) > 0),
met AS (SELECT p, t FROM (SELECT p, unnest(a) AS w FROM ps) JOIN (SELECT t, unnest(b) AS w FROM ts) USING (w)
        UNION SELECT p, t FROM ps, ts WHERE abs(length(p) - length(t)) <= 0.205 * (length(p) + length(t)) + 0.001
          AND levenshtein(p, t) <= CASE WHEN strlen(p) = length(p) AND strlen(t) = length(t) THEN 0.205 ELSE 0.82 END * (length(p) + length(t)) + 0.001),
pairs AS (SELECT p, t, a, b FROM met JOIN ps USING (p) JOIN ts USING (t)),
{tail},
authors AS (SELECT phrase, author, count(*) AS n FROM (SELECT phrase, unnest(author) AS author FROM listed JOIN corpus USING (doc_id)) GROUP BY ALL)
SELECT topic, author, CAST(sum(n) AS BIGINT) AS n FROM good
JOIN (SELECT phrase, array_to_string(a, ' ') AS p FROM phrases) USING (p) JOIN (SELECT topic, array_to_string(b, ' ') AS t FROM topics) USING (t)
JOIN authors USING (phrase) GROUP BY topic, author"""


def _english_tokens(text: str, letters: str = r"\p{L}", others: str = "") -> str:
    """Joining signs between letters, or between digits, are marked first, as this engine's patterns cannot look around.

    ``others`` are patterns of words without such letters.
    """
    marks = {sign: chr(0xE000 + i) for i, sign in enumerate("'’.:,;")}
    for signs, left, right in (("'’.:", letters + r"\p{M}", letters), ("'’.,;", r"\p{N}", r"\p{N}")):
        for sign in signs:
            # Twice, as a letter can stand between two signs.
            for _ in range(2):
                text = f"regexp_replace({text}, '([{left}])[{sign.replace(chr(39), chr(39) * 2)}]([{right}])', '\\1{marks[sign]}\\2', 'g')"
    back = "w"
    for sign, mark in marks.items():
        back = f"replace({back}, '{mark}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return rf"""WITH marked AS (SELECT doc_id, regexp_extract_all({text}, '[{letters}\p{{M}}\p{{N}}_{''.join(marks.values())}]+{others}') AS w FROM documents),
listed AS (SELECT doc_id, unnest(w) AS w, CAST(unnest(range(len(w))) AS INTEGER) AS pos FROM marked),
words AS (SELECT doc_id, pos, regexp_replace({back}, '[''’]s$', '') AS term FROM listed)
SELECT doc_id, pos, term FROM words WHERE term NOT IN ({_STOP})"""


def _shape(word: str) -> str:
    """V or C for every letter; a y is a vowel after a consonant."""
    shape = f"regexp_replace(regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g'), '^y', 'C')"
    for _ in range(3):
        shape = f"replace(replace({shape}, 'Cy', 'CV'), 'Vy', 'VC')"
    return shape


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'VC', ''))) // 2)"


def _stemmed() -> str:
    """Porter's steps as common tables, from ``vocabulary`` (word, df) to ``stemmed``."""
    short = "regexp_matches(shape, 'CVC$') AND length(root) > 2 AND right(root, 1) NOT IN ('w', 'x', 'y')"
    double = "length(root) > 1 AND right(root, 1) = substr(root, length(root) - 1, 1) AND right(shape, 1) = 'C'"
    parts = [
        """s0 AS (SELECT word, df, CASE WHEN ends_with(word, 'sses') OR ends_with(word, 'ies') THEN left(word, length(word) - 2)
  WHEN ends_with(word, 's') AND NOT ends_with(word, 'ss') THEN left(word, length(word) - 1) ELSE word END AS w FROM vocabulary)""",
        f"""e1 AS (SELECT *, CASE WHEN ends_with(w, 'eed') THEN 'eed'
  WHEN ends_with(w, 'ed') AND contains({_shape("left(w, length(w) - 2)")}, 'V') THEN 'ed'
  WHEN ends_with(w, 'ing') AND contains({_shape("left(w, length(w) - 3)")}, 'V') THEN 'ing' ELSE '' END AS ending FROM s0)""",
        "r1 AS (SELECT *, left(w, length(w) - length(ending)) AS root FROM e1)",
        f"h1 AS (SELECT *, {_shape('root')} AS shape FROM r1)",
        f"""s1 AS (SELECT word, df, CASE WHEN ending = '' THEN w
  WHEN ending = 'eed' THEN CASE WHEN {_measure('shape')} > 0 THEN left(w, length(w) - 1) ELSE w END
  WHEN ends_with(root, 'at') OR ends_with(root, 'bl') OR ends_with(root, 'iz') THEN root || 'e'
  WHEN {double} THEN CASE WHEN right(root, 1) IN ('l', 's', 'z') THEN root ELSE left(root, length(root) - 1) END
  WHEN {_measure('shape')} = 1 AND {short} THEN root || 'e' ELSE root END AS w FROM h1)""",
        f"""z1 AS (SELECT word, df, CASE WHEN ends_with(w, 'y') AND contains({_shape("left(w, length(w) - 1)")}, 'V')
  THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM s1)""",
    ]
    last = "z1"
    for n, (table, least) in enumerate(((STEP_2, 0), (STEP_3, 0), (STEP_4, 1)), 2):
        ordered = sorted(table, key=len, reverse=True)
        found = " ".join(f"WHEN ends_with(w, '{e}') THEN '{e}'" for e in ordered)
        new = " ".join(f"WHEN '{e}' THEN '{table[e]}'" for e in ordered)
        parts += [
            f"e{n} AS (SELECT *, CASE {found} ELSE '' END AS ending FROM {last})",
            f"r{n} AS (SELECT *, left(w, length(w) - length(ending)) AS root FROM e{n})",
            f"h{n} AS (SELECT *, {_shape('root')} AS shape FROM r{n})",
            f"""s{n} AS (SELECT word, df, CASE WHEN ending = '' OR {_measure('shape')} <= {least}
  OR (ending = 'ion' AND right(root, 1) NOT IN ('s', 't')) THEN w ELSE root || CASE ending {new} END END AS w FROM h{n})""",
        ]
        last = f"s{n}"
    parts += [
        f"r5 AS (SELECT *, left(w, length(w) - 1) AS root FROM {last})",
        f"h5 AS (SELECT *, {_shape('root')} AS shape FROM r5)",
        f"""s5 AS (SELECT word, df, CASE WHEN ends_with(w, 'e') AND ({_measure('shape')} > 1
  OR ({_measure('shape')} = 1 AND NOT ({short}))) THEN root ELSE w END AS w FROM h5)""",
        f"h6 AS (SELECT *, {_shape('w')} AS shape FROM s5)",
        f"""stemmed AS (SELECT word, CASE WHEN length(word) < 3 THEN word
  WHEN ends_with(w, 'll') AND {_measure('shape')} > 1 THEN left(w, length(w) - 1) ELSE w END AS stem, df FROM h6)""",
    ]
    return ",\n".join(parts)


_KNOWN_ITEMS = f"""
asked AS (SELECT DISTINCT unnest({_RUNS}) AS query_id FROM corpus),
listed_phrases AS (SELECT query_id, regexp_extract_all(lower(query_id), '{SIMPLE_WORD}') AS w FROM asked),
ft AS (SELECT query_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM listed_phrases),
kept AS (SELECT * FROM ft WHERE term NOT IN ({_STOP})),
clauses AS (SELECT query_id, 0 AS grp, 'must' AS occur, '0' AS clause, 'title' AS field, term,
                   pos - min(pos) OVER (PARTITION BY query_id) AS off,
                   count(*) OVER (PARTITION BY query_id) AS size, 1.0 AS boost FROM kept)"""


def oracles() -> dict[str, str]:
    yearly = _scored("venue, year", "counts", "y")
    overall = _scored("venue", "span", "s")
    top_span = _leaders("venue", "s_phrases", 5)
    plain = f"WITH {_tokens('title')}"
    sql = {
        "record_count_by_type": f"WITH {_CORPUS} SELECT type, count(*) AS records FROM corpus GROUP BY type",
        "tokens_title": f"{plain} SELECT doc_id, pos, term FROM tok",
        "tokens_simple": f"WITH {_tokens('author', 'key')} SELECT field, doc_id, CAST(pos AS INTEGER) AS pos, term FROM listed",
        "exact_field": f"WITH {_CORPUS} SELECT doc_id, CAST(1 AS DOUBLE) AS score FROM corpus WHERE type = 'article'",
        "tokens_english": _english_tokens("lower(regexp_replace(text, '([a-z])er ', '\\1er''s ', 'g'))"),
        "tokens_scripts": _english_tokens("translate(lower(text), 'aeo', '漢ひカ')", r"\p{Latin}", r"|\p{Katakana}+|[\p{Han}\p{Hiragana}]"),
        "postings_title": f"{plain} SELECT term, doc_id, tf, array_to_string(positions, ',') AS positions FROM tf",
        "term_stats": f"{plain} SELECT term, df FROM df",
        "doc_lengths": f"{plain} SELECT doc_id, length FROM dl",
        "field_stats": f"WITH {_tokens(*_FIELDS)} SELECT field, docs, tokens, round(mean_length, 6) AS mean_length FROM fs",
        "year_range": f"WITH {_CORPUS} SELECT doc_id, CAST(1 AS DOUBLE) AS score FROM corpus WHERE year BETWEEN 2015 AND 2017",
        "year_single": f"WITH {_CORPUS} SELECT doc_id, CAST(1 AS DOUBLE) AS score FROM corpus WHERE year = 2016",
        "year_batch": f"""WITH {_CORPUS},
spans AS (SELECT CAST(item_id AS VARCHAR) AS query_id, 2012 + item_id % 7 AS a, 2012 + item_id % 11 AS b FROM benchmark),
answer AS (SELECT query_id, doc_id, CAST(1 AS DOUBLE) AS score FROM spans JOIN corpus ON year BETWEEN a AND b)"""
        + _RANK.format(limit="WHERE rank <= 20"),
        "search_term": _search(_values(*_single("must", "eriner"))),
        "search_should": _search(_values(*_single("should", "eriner", "thanea", "heed"))),
        "search_must": _search(_values(*_single("must", "er", "re"), (0, "should", "extra", "title", "thanea", 0, 1))),
        "search_must_not": _search(_values(*_single("must", "heed"), (0, "must_not", "bar", "title", "eash", 0, 1))),
        "search_phrase": _search(_values(*_phrase("p", ("eriner", 0), ("thanea", 1)))),
        "search_phrase_gap": _search(_values(*_phrase("p", ("attion", 0), ("thanedble", 2), ("anea", 4)))),
        "search_phrase_slop": f"""WITH {_tokens('title')},
placed AS (SELECT doc_id, pos AS start, 0 AS off FROM tok WHERE term = 'thanedble'
           UNION ALL SELECT doc_id, pos - 1, 1 FROM tok WHERE term = 'eriner'),
ends AS (SELECT p.doc_id, p.start AS ending, max(q.start) FILTER (WHERE q.off = 0) AS one, max(q.start) FILTER (WHERE q.off = 1) AS two
         FROM placed p JOIN placed q ON p.doc_id = q.doc_id AND q.start <= p.start GROUP BY p.doc_id, p.start),
windows AS (SELECT doc_id, least(one, two) AS begin, min(ending) - least(one, two) AS width FROM ends
            WHERE one IS NOT NULL AND two IS NOT NULL GROUP BY doc_id, least(one, two)),
near AS (SELECT doc_id, sum(1 / (1 + width)) AS freq FROM windows WHERE width <= 3 GROUP BY doc_id),
weight AS (SELECT sum(ln(1 + (docs - df + 0.5) / (df + 0.5))) AS weight, any_value(mean_length) AS mean_length
           FROM df JOIN fs USING (field) WHERE term IN ('thanedble', 'eriner')),
answer AS (SELECT 'q' AS query_id, doc_id, round(weight * freq / (freq + 1.2 * (1 - 0.75 + 0.75 * length / mean_length)), 9) AS score
           FROM near JOIN dl USING (doc_id) CROSS JOIN weight)"""
        + _RANK.format(limit="WHERE rank <= 20"),
        "search_boost": _search(
            _values((0, "should", "a", "title", "eriner", 0, 1, 1.0), (0, "should", "b", "title", "thanea", 0, 1, 2.5))
        ),
        "search_author_any": _search(_values(*_single("should", "a3", "b7", field="author", grp=1))),
        "search_venue": _search(_values(*_venue("src3", raw="src3"))),
        "search_return_all": _search(_values(*_venue("src3", raw="src3")), limit=""),
        "search_multi": _search(
            _values(
                *_single("must", "er"),
                *_single("should", "a3", "a5", "b7", "b9", "b11", field="author", grp=1),
                *_venue("src3", "src7", "src11", raw="src3 src7 src11"),
            ),
            constant=" + 1",
            years="c.year BETWEEN 2014 AND 2016",
        ),
        "search_batch": _search(_BENCHMARK_WORDS),
        "search_batch_keywords": _search(_BENCHMARK_KEYWORDS),
        "search_top_bounded": _search(_BENCHMARK_WORDS),
        "search_three_musts": _search(_THREE_MUSTS),
        "posting_bounds": f"""{plain} SELECT term, doc_id // 16 AS block, count(*) AS docs,
  round(max(tf / (tf + 1.2 * (1 - 0.75 + 0.75 * length / mean_length))), 6) AS bound
FROM tf JOIN df USING (field, term) JOIN dl USING (field, doc_id) JOIN fs USING (field) WHERE df >= greatest(128, docs // 8) GROUP BY ALL""",
        "posting_bitmaps": f"""{plain} SELECT term, CASE WHEN doc_id > 0 THEN 1 + (doc_id - 1) // 32768 ELSE doc_id // 32768 END AS run,
  CAST(count(*) AS INTEGER) AS docs, min(doc_id) AS first, max(doc_id) AS last, CAST(sum(doc_id) AS BIGINT) AS total
FROM tf JOIN df USING (field, term) WHERE df >= 256 GROUP BY ALL""",
        "fuzzy_vocabulary": f"WITH RECURSIVE {_tokens('title')}, {_FUZZY_WORDS} SELECT b AS word, a AS term, apart FROM distances WHERE apart <= 2",
        "shaped_vocabulary": f"""{plain}, {_BENCHMARK_VOCABULARY}
SELECT 'wildcard' AS kind, word, term FROM asked JOIN vocabulary ON contains(term, substr(word, 2, 3)) WHERE length(word) >= 4
UNION ALL SELECT 'regex', word, term FROM asked JOIN vocabulary
  ON regexp_full_match(term, left(word, 2) || '[a-z]*' || right(word, 3)) WHERE length(word) >= 4""",
        "ranged_vocabulary": f"""{plain}, {_BENCHMARK_VOCABULARY},
met AS (SELECT 'range' AS kind, word, term FROM asked JOIN vocabulary ON term BETWEEN word AND word || 'z'
        UNION ALL SELECT 'prefix', word, term FROM asked JOIN vocabulary ON starts_with(term, substr(word, 1, 4)))
SELECT kind, word, count(*) AS terms, min(term) AS first, max(term) AS last FROM met GROUP BY ALL""",
        "search_known_items": _search(_KNOWN_ITEMS),
        "search_prefix": _patterns("starts_with(term, 'erine')"),
        "search_wildcard": _patterns("regexp_full_match(term, '(?s)er.n.*sh')"),
        "search_regex": _patterns("regexp_full_match(term, 'th(an|in)e[ae]')"),
        "search_fuzzy": f"""WITH RECURSIVE {_tokens('title')}, asked AS (SELECT 'q' AS query_id, 'eriner' AS text, 2 AS edits), {_FUZZY.strip()},
answer AS (SELECT query_id, doc_id, round(max(weight), 9) AS score FROM near JOIN tf USING (term) GROUP BY ALL)"""
        + _RANK.format(limit="WHERE rank <= 20"),
        "search_pattern_batch": f"WITH RECURSIVE {_tokens('title')}, {_PATTERN_BATCH.strip()}" + _RANK.format(limit="WHERE rank <= 20"),
        "search_author_or_venue": _search(
            _values(*_single("should", "a3", "src7", field="author", grp=1), *_single("should", "a3", "src7", field="booktitle", grp=1))
        ),
        "search_keyword_and_prefix": _search(
            _values(*_single("must", "heed")),
            constant=" + 1",
            years="h.doc_id IN (SELECT doc_id FROM tf WHERE field = 'title' AND starts_with(term, 'erine'))",
        ),
        "search_term_range": _patterns("term BETWEEN 'thana' AND 'thanz'", "term BETWEEN 'heea' AND 'heed'"),
        "phrases": f"WITH {_COUNTS} SELECT venue, year, phrase, n FROM counts",
        "word_scores": f"WITH {_COUNTS}, {yearly} SELECT venue, year, word, degree, freq, round(word_score, 6) AS word_score FROM y_words",
        "phrase_scores": f"WITH {_COUNTS}, {yearly} SELECT venue, year, phrase, n, round(score, 6) AS score FROM y_phrases",
        "hotspots_by_year": f"WITH {_COUNTS}, {yearly} {_SHOW} ({_leaders('venue, year', 'y_phrases', 5)})",
        "hotspots_filled": f"""WITH {_COUNTS}, {yearly}, top AS ({_leaders('venue, year', 'y_phrases', 1)}),
grid AS (SELECT venue, CAST(unnest(range(2013, 2020)) AS INTEGER) AS year FROM (SELECT DISTINCT booktitle AS venue FROM corpus))
{_SHOW} (SELECT g.venue, g.year, t.phrase, t.n, t.score, t.rank FROM grid g LEFT JOIN top t USING (venue, year))""",
        "hotspot_evolution": f"""WITH {_COUNTS}, {yearly}, {_SPAN}, {overall}, top AS ({top_span}),
kept AS (SELECT * FROM y_phrases WHERE (venue, phrase) IN (SELECT (venue, phrase) FROM top))
{_SHOW} ({_leaders('venue, year', 'kept', 5)})""",
        "hotspot_series": f"""WITH {_COUNTS}, {_SPAN}, {overall}, top AS ({top_span}),
grid AS (SELECT venue, phrase, CAST(unnest(range(2014, 2019)) AS INTEGER) AS year FROM top)
SELECT g.venue, g.phrase, g.year, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN counts c USING (venue, phrase, year)""",
        "pivot_authors_exact": f"""WITH {_CORPUS},
listed AS (SELECT doc_id, unnest({_RUNS}) AS phrase FROM corpus WHERE year BETWEEN 2014 AND 2018),
sets AS (SELECT doc_id, list_distinct(regexp_extract_all(
           regexp_replace(lower(phrase), '[\\x{{80}}-\\x{{ff}}]', '', 'g'), '[\\p{{L}}\\p{{N}}]+')) AS w FROM listed),
full_matches AS (SELECT doc_id FROM sets WHERE len(w) > 0 AND list_has_any(w, ['eriner', 'thanea'])
                 AND (list_has_all(w, ['eriner', 'thanea']) OR list_has_all(['eriner', 'thanea'], w)))
SELECT 'eriner thanea' AS topic, author, count(*) AS n
FROM (SELECT unnest(c.author) AS author FROM full_matches JOIN corpus c USING (doc_id)) GROUP BY author""",
        "pivot_authors_fuzzy": f"""WITH {_CORPUS}, {_FUZZY_TOPICS.strip()}
SELECT topic, author, count(*) AS n FROM (
  SELECT g.topic, unnest(c.author) AS author FROM listed l JOIN good g USING (phrase) JOIN corpus c USING (doc_id))
GROUP BY topic, author""",
        "topic_authors": _topic_authors(),
        "stemmed_vocabulary": f"""WITH listed AS (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{SIMPLE_WORD}'))) AS word FROM documents),
vocabulary AS (SELECT word, count(*) AS df FROM listed GROUP BY word),
{_stemmed()}
SELECT word, stem, df FROM stemmed""",
        "page_key_tokens": f"""WITH w AS (SELECT page_id, regexp_extract_all(lower(url), '{SIMPLE_WORD}') AS w FROM pages)
SELECT page_id, unnest(w) AS term, CAST(unnest(range(len(w))) AS INTEGER) AS pos FROM w""",
        "record_dump_scan": f"""WITH {_CORPUS} SELECT file, key, 'inproceedings' AS type, year, booktitle, CAST(NULL AS VARCHAR) AS journal,
array_to_string(author, ', ') AS authors, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS title
FROM corpus, (VALUES ('plain'), ('gzip')) AS f(file)""",
        "page_entities_decoded": """WITH texts AS (SELECT page_id, regexp_extract_all(html, '[^<>]*&(?:middot|copy);[^<>]*') AS t FROM pages),
placed AS (SELECT page_id, unnest(t) AS text, unnest(range(len(t))) AS i FROM texts),
firsts AS (SELECT page_id, text, min(i) AS i FROM placed GROUP BY ALL),
numbered AS (SELECT page_id, text, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS n FROM firsts)
SELECT concat(page_id, '/', n) AS key, regexp_replace(replace(replace(replace(replace(replace(replace(text,
  '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '^\\s+|\\s+$', '', 'g') AS title
FROM numbered""",
        "record_parse": f"""WITH {_CORPUS} SELECT key, 'inproceedings' AS type, year, booktitle,
array_to_string(author, ', ') AS authors, regexp_replace(title, '\\s+', '', 'g') AS title FROM corpus""",
    }
    columns = ", ".join(f"CAST(sum(n) FILTER (WHERE year = {y}) AS BIGINT) AS y{y}" for y in range(2014, 2019))
    sql["hotspot_table"] = f"WITH series AS ({sql['hotspot_series']}) SELECT venue, phrase, {columns} FROM series GROUP BY ALL"
    merged = _COUNTS.replace("SELECT booktitle AS venue", "SELECT 'src3 src7' AS venue").replace(
        "FROM corpus WHERE", "FROM corpus WHERE booktitle IN ('src3', 'src7') AND"
    )
    blocked = _COUNTS.replace("text AS title", "concat(text, chr(10), source, ' case study. ', source, ' new venue. ') AS title")
    sql["hotspots_blocked"] = f"WITH {blocked}, {yearly} {_SHOW} ({_leaders('venue, year', 'y_phrases', 5)})"
    sql["fresh_dumps"] = f"""WITH {_CORPUS} SELECT key, type, year, regexp_replace(title, '\\s+', '', 'g') AS title FROM corpus WHERE doc_id % 2 = 0"""
    sql["dump_entities"] = f"""WITH {_CORPUS} SELECT key, CASE WHEN doc_id % 10 > 1 THEN regexp_replace(title, '\\s+', '', 'g') ELSE '' END AS title,
CASE WHEN doc_id % 10 > 1 THEN '' ELSE 'unknown entity' END AS reason FROM corpus"""
    sql["searched_hotspots"] = f"WITH {merged}, {yearly} {_SHOW} ({_leaders('venue, year', 'y_phrases', 5)})"
    lower = merged.replace("'src3 src7'", "'SRC3 src7'")
    sql["searched_evolution"] = f"""WITH {lower}, {yearly}, {_SPAN}, {overall}, top AS ({top_span}),
kept AS (SELECT * FROM y_phrases WHERE (venue, phrase) IN (SELECT (venue, phrase) FROM top)),
shown AS ({_SHOW} ({_leaders('venue, year', 'kept', 5)}))
SELECT 'SRC3 src7' AS venue, CAST(y AS INTEGER) AS year, phrase, n, score, rank
FROM (SELECT unnest(range(2013, 2019)) AS y) LEFT JOIN shown ON year = y"""
    topic = _FUZZY_TOPICS.replace("FROM corpus WHERE", "FROM corpus WHERE booktitle IN ('src3', 'src7', 'src11', 'src12') AND")
    sql["searched_authors"] = f"""WITH {_CORPUS}, {topic.strip()},
counted AS (SELECT topic, author, count(*) AS n FROM (
  SELECT g.topic, unnest(c.author) AS author FROM listed l JOIN good g USING (phrase) JOIN corpus c USING (doc_id)
  WHERE topic = 'eriner thanea') GROUP BY topic, author)
SELECT topic, author, n, CAST(row_number() OVER (ORDER BY n DESC, author) AS INTEGER) AS rank FROM counted"""
    batch = sql["search_batch"]
    sql["hits_with_records"] = f"""WITH hits AS ({batch}), {_CORPUS}
SELECT h.query_id, h.rank, h.doc_id, h.score, c.key, c.year, array_to_string(c.author, ', ') AS authors, l.quality, l.toxic
FROM hits h JOIN corpus c USING (doc_id) LEFT JOIN labels l USING (doc_id)"""
    sql["hits_as_json"] = sql["hits_with_records"]
    return sql
