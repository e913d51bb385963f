"""The operators applied to their whole tables with production parameters, by query name."""

from __future__ import annotations

from pyspark.sql import functions as F

from commutewell.llm import (
    langid,
    licenses,
    manifest,
    mixing,
    neardup,
    oph,
    packing,
    secrets,
    sharding,
    spelling,
    templates,
    toxicity,
    vafile,
)
from commutewell.llm.common import table
from commutewell.session import work_dir


def op1_pfair_mixing(spark, sf_dir):
    """Sources by the square root of their rows; one row per document with its block's window and its place."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", "block", "release", "deadline", "turn", "place")


def op2_vector_approximation(spark, sf_dir):
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_word_backoff(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark, sf_dir):
    out = sharding.shard(table(spark, sf_dir, "documents"), work_dir(spark, "slot-map"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def op5_sentence_rules(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_site_templates(spark, sf_dir):
    return templates.main_texts(table(spark, sf_dir, "pages"))


def op7_weighted_lexicon(spark, sf_dir):
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_one_permutation(spark, sf_dir):
    return oph.fingerprints(table(spark, sf_dir, "documents"))


def op9_grouping_genetic(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark, sf_dir):
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_bit_sliced_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_pointer_proofs(spark, sf_dir):
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op13_linked_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def queries():
    named = [(name, value) for name, value in globals().items() if name.startswith("op") and name[2].isdigit()]
    return dict(sorted(named, key=lambda x: int(x[0][2:].split("_")[0])))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses_sql() -> str:
    """The sentence rules as DuckDB lists, from the same sentences and rules."""
    names = ", ".join(f"{_text(sentence)}: {_text(name)}" for sentence, name in licenses.known().items())
    rules = ", ".join(f"{{'license': {_text(lic)}, 'rule': {_text(f' {rule} ')}}}" for lic, rule in licenses.RULES)
    ids = lambda ends: (
        f"list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), {_text(ends)}), "
        "lambda s: known[trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL)"
    )
    hits = lambda col: f"list_filter(rules, lambda r: contains(' ' || array_to_string({col}, ' ') || ' ', r.rule))"
    outer = lambda h: f"list_filter({h}, lambda r: len(list_filter({h}, lambda o: o.rule <> r.rule AND contains(o.rule, r.rule))) = 0)"
    return f"""
WITH c AS (SELECT MAP {{{names}}} AS known, [{rules}] AS rules),
     s AS (SELECT doc_id, {ids(licenses.WRAPPED)} AS wrapped, {ids(licenses.LINES)} AS lines, rules FROM documents, c),
     h AS (SELECT doc_id, wrapped, lines, {hits("wrapped")} AS hw, {hits("lines")} AS hl FROM s),
     a AS (SELECT doc_id, wrapped, lines, list_distinct(list_concat(hw, hl)) AS every FROM h),
     m AS (SELECT doc_id, wrapped, lines, {outer("every")} AS hits FROM a)
SELECT doc_id,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(hits, lambda x: x.license))), ','), '') AS licenses,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(wrapped, lines))), ','), '') AS sentences,
       coalesce(array_to_string(list_sort(list_transform(hits, lambda x: trim(x.rule))), ','), '') AS rules
FROM m"""


_TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""


_NEAR_SQL = r"""
WITH RECURSIVE
  w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS sh FROM w),
  e AS (SELECT doc_id, unnest(sh) AS x FROM s),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  l AS (SELECT a, b FROM p JOIN s x ON a = x.doc_id JOIN s y ON b = y.doc_id WHERE 100 * n >= 75 * (len(x.sh) + len(y.sh) - n)),
  r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
  c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON doc_id = a"""


# Frames of 1,000 turns, blocks of 16 rows, chunks of 512 rows, as the operator's parameters say.
_MIXING_SQL = """
WITH RECURSIVE
  d AS (SELECT doc_id, source, coalesce('=' || source, '-') AS key, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h FROM documents),
  g AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % greatest(1, (SELECT count(*) FROM d) // 512) AS chunk FROM d),
  r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY chunk, h, doc_id) - 1 AS nr FROM g),
  c AS (SELECT key AS k, sqrt(count(*)) AS w, (count(*) + 15) // 16 AS n FROM d GROUP BY key),
  -- Phases: whole turns of 10,000 by largest remainder, one where the share is less, for the sources that have blocks left.
  p AS (SELECT CAST(0 AS BIGINT) AS turn, list({'k': k, 'w': w, 'n': n, 'done': CAST(0 AS BIGINT)} ORDER BY k) AS st FROM c
        UNION ALL
        SELECT turn + frames * 10000, list_filter(list_transform(range(1, len(st) + 1), lambda i: {'k': st[i].k, 'w': st[i].w,
                 'n': st[i].n - least(st[i].n, frames * q[i]), 'done': st[i].done + least(st[i].n, frames * q[i])}), lambda s: s.n > 0)
        FROM (SELECT *, 1 + list_min(list_transform(range(1, len(st) + 1), lambda i: st[i].n // q[i])) AS frames FROM
          (SELECT *, list_transform(range(1, len(st) + 1), lambda i: CAST(floor(x[i]) AS BIGINT) + CASE WHEN
                   len(list_filter(range(1, len(st) + 1), lambda j: x[j] - floor(x[j]) > x[i] - floor(x[i])
                     OR (x[j] - floor(x[j]) = x[i] - floor(x[i]) AND j < i)))
                   < 10000 - list_sum(list_transform(x, lambda y: floor(y))) THEN 1 ELSE 0 END) AS q FROM
            (SELECT turn, st, list_transform(st, lambda s: CASE WHEN list_contains(big, s.w)
              THEN greatest(1.0, (10000 - (len(st) - len(big))) * s.w / list_sum(big)) ELSE 1.0 END) AS x FROM
              (SELECT turn, st, list_filter(list_transform(st, lambda s: s.w), lambda v: (10000 - len(list_filter(st, lambda o: o.w < v))) * v
                 >= list_sum(list_transform(list_filter(st, lambda o: o.w >= v), lambda o: o.w))) AS big FROM p))))
        WHERE len(list_filter(range(1, len(st) + 1), lambda i: st[i].n > frames * q[i])) > 0),
  q AS (SELECT turn, st, list_transform(range(1, len(st) + 1), lambda i: CAST(floor(x[i]) AS BIGINT) + CASE WHEN
               len(list_filter(range(1, len(st) + 1), lambda j: x[j] - floor(x[j]) > x[i] - floor(x[i])
                 OR (x[j] - floor(x[j]) = x[i] - floor(x[i]) AND j < i)))
               < 10000 - list_sum(list_transform(x, lambda y: floor(y))) THEN 1 ELSE 0 END) AS q FROM
        (SELECT turn, st, list_transform(st, lambda s: CASE WHEN list_contains(big, s.w)
              THEN greatest(1.0, (10000 - (len(st) - len(big))) * s.w / list_sum(big)) ELSE 1.0 END) AS x FROM
              (SELECT turn, st, list_filter(list_transform(st, lambda s: s.w), lambda v: (10000 - len(list_filter(st, lambda o: o.w < v))) * v
                 >= list_sum(list_transform(list_filter(st, lambda o: o.w >= v), lambda o: o.w))) AS big FROM p))),
  -- One frame of each phase: in every turn the released block with the earliest deadline.
  e AS (SELECT turn, q, list_transform(q, lambda y: CAST(0 AS BIGINT)) AS nxt, CAST(-1 AS BIGINT) AS t, CAST(NULL AS BIGINT) AS i, CAST(NULL AS BIGINT) AS k FROM q
        UNION ALL
        SELECT turn, q, list_transform(range(1, len(q) + 1), lambda j: nxt[j] + CASE WHEN j = b.i THEN 1 ELSE 0 END), t + 1, b.i, nxt[b.i]
        FROM (SELECT *, list_sort(list_transform(list_filter(range(1, len(q) + 1), lambda j: nxt[j] < q[j] AND nxt[j] * 10000 // q[j] <= t + 1),
                lambda j: {'due': ((nxt[j] + 1) * 10000 + q[j] - 1) // q[j], 'i': j}))[1] AS b FROM e WHERE t < 9999)),
  s AS (SELECT turn, st[i].k AS key, CAST(st[i].done AS BIGINT) AS first, q[i] AS q FROM
        (SELECT turn, st, q, unnest(range(1, len(st) + 1)) AS i FROM q)),
  o AS (SELECT e.turn, q.st[e.i].k AS key, e.k, e.t AS slot FROM e JOIN q ON e.turn = q.turn WHERE e.t >= 0),
  b AS (SELECT r.*, nr // 16 AS block, nr % 16 AS place FROM r),
  a AS (SELECT b.*, s.turn AS start, s.first, s.q FROM b JOIN s ON b.key = s.key AND s.first <= block
        QUALIFY row_number() OVER (PARTITION BY b.key, b.nr ORDER BY s.first DESC) = 1),
  f AS (SELECT *, start + (block - first) // q * 10000 AS base, (block - first) % q AS k FROM a)
SELECT f.doc_id, f.source, CAST(block AS BIGINT) AS block, CAST(base + f.k * 10000 // f.q AS BIGINT) AS release,
       CAST(base + ((f.k + 1) * 10000 + f.q - 1) // f.q AS BIGINT) AS deadline, CAST(base + o.slot AS BIGINT) AS turn, CAST(place AS INTEGER) AS place
FROM f JOIN o ON f.start = o.turn AND f.key = o.key AND f.k = o.k"""


# The checksum of a list of bytes, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

_VARIANTS_SQL = f"""
WITH RECURSIVE
  r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents),
  d AS (SELECT doc_id, run, count(*) AS c FROM r WHERE length(run) >= 7 GROUP BY 1, 2),
  b AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
               lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS bytes FROM d),
  h AS (SELECT run, c, {_CRC32.format(bytes="bytes")} AS h FROM b),
  o AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
  v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM o WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
  i AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
  m AS (SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS m, substr(word, 1, i) || substr(word, i + 2) AS s FROM i),
  l AS (SELECT DISTINCT m.word AS long, m.n AS long_n, v.word AS short, v.n AS short_n FROM m JOIN v ON m.s = v.word),
  p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM m a JOIN m b ON a.m = b.m AND a.word <> b.word
        UNION ALL SELECT long, short, short_n FROM l UNION ALL SELECT short, long, long_n FROM l),
  q AS (SELECT word, count(*) AS n_near, first({{'n': near_n, 'near': near}} ORDER BY near_n DESC, near) AS best FROM p GROUP BY 1),
  f AS (SELECT v.word, CASE WHEN best.n >= 10 * v.n THEN best.near END AS form, v.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN best.n >= 10 * v.n THEN best.n END AS form_n FROM v LEFT JOIN q ON v.word = q.word),
  x AS (SELECT word, word AS root, form AS next FROM f
        UNION ALL SELECT x.word, f.word, f.form FROM x JOIN f ON x.next = f.word)
SELECT f.word, f.form, x.root, f.n, f.n_near, f.form_n FROM f JOIN x ON f.word = x.word AND x.next IS NULL"""


def _leaf_sql(changed: str) -> str:
    texts = [f"CAST({c + ' + ' + changed if c == 'n_chars' else c} AS VARCHAR)" for c in manifest.FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


_TREE_SQL = """SELECT {key}, 0 AS level, list(digest ORDER BY {order}) AS nodes FROM {leaves} GROUP BY 1
        UNION ALL
        SELECT {key}, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
        FROM {name} WHERE len(nodes) > 1"""

_MANIFEST_SQL = f"""
WITH RECURSIVE
  c AS (SELECT doc_id, coalesce('=' || lang, '-') AS k, {_leaf_sql("0")} AS digest, {_leaf_sql("1")} AS changed,
               {_CRC32.format(bytes="list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: unicode(x))")} % 7 = 0 AS hit FROM documents),
  d AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, digest) - 1 AS pos FROM c),
  t AS ({_TREE_SQL.format(key="k", order="pos", leaves="d", name="t")}),
  s AS (SELECT k, nodes[1] AS digest, row_number() OVER (ORDER BY k) - 1 AS place, 0 AS z FROM t WHERE len(nodes) = 1),
  u AS ({_TREE_SQL.format(key="z", order="place", leaves="s", name="u")}),
  -- The siblings of a leaf: its own tree's, then those of the tree of subroots.
  n AS (SELECT d.k, d.pos, t.level, (d.pos >> t.level) AS place, t.nodes FROM d JOIN t ON d.k = t.k AND len(t.nodes) > 1
        UNION ALL
        SELECT d.k, d.pos, 100 + u.level, s.place >> u.level, u.nodes FROM d JOIN s ON d.k = s.k JOIN u ON len(u.nodes) > 1),
  p AS (SELECT k, pos, list({{'left': CASE WHEN place % 2 = 1 THEN nodes[place] END, 'right': CASE WHEN place % 2 = 0 THEN nodes[place + 2] END}} ORDER BY level) AS path
        FROM n GROUP BY 1, 2),
  a AS (SELECT d.*, coalesce(path, []) AS path, s.digest AS subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root
        FROM d JOIN s ON d.k = s.k LEFT JOIN p ON d.k = p.k AND d.pos = p.pos),
  f AS (SELECT k, pos, path, 0 AS i, CASE WHEN hit THEN changed ELSE digest END AS node FROM a
        UNION ALL
        SELECT k, pos, path, i + 1, sha256(coalesce(path[i + 1].left, '') || node || coalesce(path[i + 1].right, '')) FROM f WHERE i < len(path))
SELECT doc_id, digest AS leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(a.path, lambda x: coalesce(x.left, x.right, '')), ''), '')) AS proof_sha256,
       f.node AS folded_root, f.node = root AS verified
FROM a JOIN f ON a.k = f.k AND a.pos = f.pos AND f.i = len(f.path)"""


def oracle_sql():
    return {
        "op1_pfair_mixing": _MIXING_SQL, "op2_vector_approximation": _TOP_K_SQL, "op5_sentence_rules": _licenses_sql(), "op10_minhash_near_dedup": _NEAR_SQL,
        "op11_bit_sliced_variants": _VARIANTS_SQL, "op12_pointer_proofs": _MANIFEST_SQL,
    }
