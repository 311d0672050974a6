"""The operators over whole benchmark tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirhouse.llm import (
    chat,
    ctw,
    decontam,
    importance,
    license_scan,
    line_dedup,
    merkle,
    near_dup,
    packing,
    repetition,
    substring_dedup,
    token_store,
    toxicity,
)
from weirhouse.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark, sf_dir):
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, pos, string_split(coalesce(text, ''), chr(10))[pos] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), held AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AS gone FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op2_license_scan(spark, sf_dir):
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark, sf_dir):
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join("item_ids", ",")
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.encode(items, "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op5_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(turns.unionByName(extra)))


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


ORACLES["op5_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT conv_id, turn, role AS r, text AS x, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST)) AS loss_sha256,
  CAST(sum({len(chat.HEAD + chat.HEAD_END + chat.FOOTER)} + length(replace({_escaped_sql('role')}, '|>', '|\\>')) + length({_escaped_sql('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


@query
def op6_token_store(spark, sf_dir):
    path = token_store.store_dir(spark)
    token_store.write_store(table(spark, sf_dir, "documents"), path)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(~toxicity.learned_rows(), F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_repetition(spark, sf_dir):
    found = repetition.quality(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_fraction", "longest_repeat",
    )


@query
def op9_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_lm_score(spark, sf_dir):
    return ctw.score(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark, sf_dir):
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    changed = F.when(hit, merkle.leaf(n_chars=F.col("n_chars") + 1))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), carry={"changed": changed})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: A CTE with the table of crc32 by its rule, and the crc32 of a text as an expression over its column ``t``.
CRC_TABLE = """
crc AS (
  SELECT list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
)"""


def crc_of(text: str) -> str:
    byte = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST('0x' || substring(hex({text}), 2 * i - 1, 2) AS BIGINT))"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {byte}), lambda c, b: {step}), 4294967295)"


def _leaf_of(n_chars: str) -> str:
    cells = [("doc_id", "doc_id"), ("source", "source"), ("lang", "lang"), ("n_chars", n_chars), ("text", "text")]
    cell = lambda v: f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(cell(v) for _, v in cells) + ")"


def _tree_of(name: str, source: str, group: str) -> str:
    """Recursive CTE of all nodes over (group, pos, h) with ``n``, the nodes of the level."""
    return f"""
{name} AS (
  SELECT {group} AS grp, 0 AS level, pos, h, count(*) OVER (PARTITION BY {group}) AS n FROM {source}
  UNION ALL
  SELECT grp, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY grp, level, pos // 2, n
)"""


def _steps_of(tree: str) -> str:
    """From a leaf's place up: each sibling with its side, or ``-`` where there is none."""
    return f"""
  SELECT a.grp, a.pos, b.level, CASE WHEN s.h IS NULL THEN '-' WHEN b.pos % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM {tree} a
  JOIN {tree} b ON a.level = 0 AND b.n > 1 AND a.grp = b.grp AND b.pos = a.pos >> b.level
  LEFT JOIN {tree} s ON s.grp = b.grp AND s.level = b.level AND s.pos = xor(b.pos, 1)"""


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE {CRC_TABLE}, leaves AS (
  SELECT doc_id, coalesce('v' || lang, '') AS grp, {_leaf_of('n_chars')} AS h,
    CASE WHEN {crc_of('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf_of('n_chars + 1')} END AS changed
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves
), {_tree_of('low', 'placed', 'grp')}, subroots AS (
  SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos FROM low WHERE n = 1
), {_tree_of('high', 'subroots', "''")}, steps AS (
  SELECT grp, pos, level, step FROM ({_steps_of('low')})
  UNION ALL
  SELECT p.grp, p.pos, 1000 + u.level, u.step
  FROM placed p JOIN subroots r ON p.grp = r.grp JOIN ({_steps_of('high')}) u ON u.pos = r.pos
), paths AS (
  SELECT grp, pos, list(step ORDER BY level) AS path FROM steps GROUP BY grp, pos
), done AS (
  SELECT p.doc_id, p.h AS leaf, r.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
    sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s[2:]), '')) AS proof_sha256,
    list_reduce(list_concat([coalesce(p.changed, p.h)], coalesce(path, [])), lambda node, s: sha256(
      CASE s[1] WHEN 'L' THEN s[2:] || node WHEN 'R' THEN node || s[2:] ELSE node END)) AS folded_root
  FROM placed p JOIN subroots r ON p.grp = r.grp LEFT JOIN paths q ON q.grp = p.grp AND q.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM done
"""


@query
def op12_importance_resampling(spark, sf_dir):
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _grams_of(source: str) -> str:
    """Words and pairs of every row of ``source`` (row, text), repeats kept."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = "regexp_extract_all(" + low + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
  SELECT row, len(w) AS n_words, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram
  FROM (SELECT row, {split} AS w FROM {source})"""


ORACLES["op12_importance_resampling"] = f"""
WITH {CRC_TABLE}, docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS row, text FROM benchmark),
doc_grams AS ({_grams_of('docs')}), item_grams AS ({_grams_of('items')}),
hashed AS (
  SELECT gram, {crc_of('gram')} % 10000 AS bucket
  FROM (SELECT gram FROM doc_grams UNION SELECT gram FROM item_grams), crc
), counted AS (
  SELECT bucket, CAST(sum(s) AS BIGINT) AS s, CAST(sum(t) AS BIGINT) AS t
  FROM (SELECT gram, 1 AS s, 0 AS t FROM doc_grams UNION ALL SELECT gram, 0, 1 FROM item_grams) JOIN hashed USING (gram)
  GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted)::DOUBLE + 10000)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted)::DOUBLE + 10000)))) AS BIGINT) AS gain
  FROM counted
), summed AS (
  SELECT row, any_value(n_words) AS n_words, count(*) AS n, CAST(sum(gain) AS BIGINT) AS gain
  FROM doc_grams JOIN hashed USING (gram) JOIN gains USING (bucket) GROUP BY row
), scored AS (
  SELECT row, doc_id, coalesce(n_words, 0) AS n_words, coalesce(n, 0) AS n_features,
    CASE WHEN n > 0 THEN (gain - ((gain % n) + n) % n) // n ELSE 0 END AS weight,
    CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM docs LEFT JOIN summed USING (row)
), noised AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT *, n_words >= 20 AS large, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, row) AS place,
    count(*) OVER (PARTITION BY n_words >= 20) AS total
  FROM noised
)
SELECT doc_id, n_features, weight, score, CASE WHEN large AND place <= 25 * total // 100 THEN place END AS rank FROM ranked
"""


@query
def op13_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLES["op13_substring_dedup"] = """
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT row, doc_id, pos, md5(array_to_string(w[pos : pos + 49], ' ')) AS h
  FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM split)
), earliest AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT row, pos + step AS pos
  FROM windows JOIN earliest USING (h), (SELECT unnest(range(50)) AS step) WHERE first < doc_id
), words AS (
  SELECT row, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM split
), kept AS (
  SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (row, pos) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row)
"""


def _split_words(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return "regexp_extract_all(" + low + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


ORACLES["op4_decontamination"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_split_words('text')} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_split_words('text')} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[pos : pos + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS pos FROM items WHERE len(w) > 0)
), runs AS (
  SELECT row, n, pos, array_to_string(w[pos : pos + n - 1], ' ') AS phrase
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT row, pos, n, item FROM runs JOIN phrases USING (n, phrase)
), covered AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY row
), found AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""


ORACLES["op9_near_dup"] = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT row, array_to_string(w[pos : pos + 4], ' ') AS shingle
  FROM (SELECT row, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS pos FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT row, count(*) AS n FROM shingles GROUP BY row
), shared AS (
  SELECT a.row AS u, b.row AS v, count(*) AS n_both FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row GROUP BY a.row, b.row
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.row = u JOIN sizes y ON y.row = v WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)
), edges AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached AS (
  SELECT row, row AS other FROM docs
  UNION
  SELECT r.row, e.v FROM reached r JOIN edges e ON r.other = e.u
), tops AS (
  SELECT r.row, min(d.doc_id) AS component_id FROM reached r JOIN docs d ON d.row = r.other GROUP BY r.row
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN tops USING (row) LEFT JOIN sizes USING (row)
"""
