"""The queries of this package, one per operator, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, exact, langid, manifest, neardup, packing, quality, secrets, sentpiece, spelling, substrings, token_counts, warc
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=2)


@_register(
    "op2_chat_formatting",
    r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?TURN\]|TURN )', '\1x\2\3', 'g')) AS chars FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 8 ELSE 14 + length(role) END)::BIGINT AS formatted_chars,
           0::BIGINT AS n_rewrites
    FROM e GROUP BY conv_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.digest(chat.format_turns(turns.unionByName(own)))


@_register("op3_suffix_array_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf_dir), length=100)


@_register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    known = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return langid.predict(docs, known).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_register("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_documents(spark, sf_dir))


@_register("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_BPE)
    both = sentpiece.decode(sentpiece.encode(_documents(spark, sf_dir), model), model)
    return both.select("doc_id", "n_pieces", F.sha2("ids", 256).alias("ids_sha256"), (F.sha2("text", 256) == F.col("text_sha256")).alias("round_trip"))


@_register("op7_secret_scans")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    forest, known = secrets.trained(docs)
    return secrets.scan(docs, forest, known)


@_register(
    "op8_quality_rules",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
    line AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
    lines AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
    win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
    three AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM win),
    place AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM three WHERE n > 1),
    rep AS (SELECT doc_id, count(*) AS n FROM place GROUP BY doc_id),
    hosts AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
    often AS (SELECT host, array_to_string(ws, ' ') AS normal FROM lines JOIN hosts USING (host)
              GROUP BY host, normal, docs HAVING count(DISTINCT t) > 10 AND count(DISTINCT t) > docs * 0.01),
    cut AS (SELECT doc_id, sum(len(ws)) AS n FROM lines JOIN often ON lines.host = often.host AND array_to_string(ws, ' ') = normal GROUP BY doc_id),
    base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(cut.n, 0)::BIGINT AS all_cut
             FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN cut USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
           NOT base_failed AND all_cut * 100 <= n_words * 70 AS kept, CASE WHEN base_failed THEN 0 ELSE all_cut END AS cut_words
    FROM base
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


@_register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), limit=512)


@_register(
    "op10_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_copies(_documents(spark, sf_dir))


#: DuckDB has no CRC-32: the table of a byte's remainders, and the sum over a list of bytes.
_CRC_TABLE = """SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS remainders
    FROM range(256) AS bytes(i)"""


def _crc(byte_list: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)"


def _merkle_levels(name: str, first: str, group: str, levels: int) -> str:
    """``{name}{i}``: nodes of a level with their place in the run, the digests before and after it there, and how many nodes the group has."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY {group}) AS m FROM ({first}))"]
    for i in range(levels):
        out.append(f"""{name}s{i} AS (SELECT *, CASE WHEN m = 1 THEN '' ELSE coalesce(string_agg(d, '') OVER (run ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
            CASE WHEN m = 1 THEN '' ELSE coalesce(string_agg(d, '') OVER (run ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
            FROM {name}{i} WINDOW run AS (PARTITION BY {group}, p // 16))""")
        out.append(f"""{name}{i + 1} AS (SELECT {group}, q AS p, d, count(*) OVER (PARTITION BY {group}) AS m FROM
            (SELECT {group}, p // 16 AS q, CASE WHEN any_value(m) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d FROM {name}{i} GROUP BY {group}, p // 16))""")
    return ",\n".join(out)


def _merkle_sql(levels: int = 6) -> str:
    """The manifest for up to 16^levels rows a source, and as many sources: the levels are written out, those above a group's root change nothing."""
    def field(c: str, value: str | None = None) -> str:
        value = value or f"{c}::VARCHAR"
        return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins = "".join(f"\n    JOIN ts{i} AS t{i}_ ON t{i}_.g = x.g AND t{i}_.p = x.p // {16 ** i}" for i in range(levels))
    joins += "".join(f"\n    JOIN us{i} AS u{i}_ ON u{i}_.p = s.p // {16 ** i}" for i in range(levels))
    # Each step of the fold is a column of its own, so that no digest is computed twice.
    steps, last = [], "start"
    for name in ("t", "u"):
        for i in range(levels):
            side, new = f"{name}{i}_", f"f{name}{i}"
            steps.append(f"CASE WHEN {side}_m = 1 THEN {last} ELSE sha256({side}_l || {last} || {side}_r) END AS {new}")
            last = new
    sides = ", ".join(f"{n}{i}_.{c} AS {n}{i}__{c}" for n in ("t", "u") for i in range(levels) for c in ("m", "l", "r"))
    nested = "SELECT * FROM wide"
    for step in steps:
        nested = f"SELECT *, {step} FROM ({nested})"
    return f"""
    WITH crc AS ({_CRC_TABLE}),
    lf AS (SELECT doc_id, coalesce('=' || source, '') AS g, source, sha256({head} || {field('text', 'text')}) AS d,
           CASE WHEN {_crc("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 5 = 0 THEN sha256({head} || {field('text', low)}) END AS forged
           FROM documents, crc),
    {_merkle_levels("t", "SELECT doc_id, g, d, coalesce(forged, d) AS start, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS p FROM lf", "g", levels)},
    sub AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS p FROM t{levels}),
    {_merkle_levels("u", "SELECT 1 AS one, subroot AS d, p FROM sub", "one", levels)},
    top AS (SELECT d AS root FROM u{levels}),
    wide AS (SELECT x.doc_id, x.d AS leaf, s.subroot, root, x.start, {sides} FROM t0 AS x JOIN sub AS s ON s.g = x.g{joins}, top)
    SELECT doc_id, leaf, subroot, root, sha256({' || '.join(f'{n}{i}__l || {n}{i}__r' for n in ('t', 'u') for i in range(levels))}) AS proof_sha256,
           {last} AS folded_root, {last} = root AS verified FROM ({nested})
    """


@_register("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_documents(spark, sf_dir)).drop("source", "position")


@_register(
    "op12_spelling_variants",
    f"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    each AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS c FROM runs WHERE length(run) >= 5 GROUP BY ALL),
    hashed AS (SELECT run, c, {_crc("flatten(list_transform(string_split(k, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))")} AS h FROM each, crc),
    words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(c)::BIGINT AS n
              FROM hashed GROUP BY 1 HAVING sum(c) >= 3 AND length(word) >= 5),
    less AS (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words),
    parts AS (SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) END AS part FROM less),
    near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM parts AS a JOIN parts AS b ON a.part = b.part AND a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
    best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
    forms AS (SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
              FROM words LEFT JOIN best USING (word)),
    up AS (SELECT word, word AS at FROM forms UNION ALL SELECT up.word, forms.form FROM up JOIN forms ON forms.word = up.at WHERE forms.form IS NOT NULL),
    ends AS (SELECT up.word, up.at AS root FROM up JOIN forms ON forms.word = up.at AND forms.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_documents(spark, sf_dir))


@_register(
    "op13_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT *, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
    SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
           array_to_string(flatten(list_transform(range(8), lambda k: list_transform([32768, 1024, 32, 1],
             lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(('0x' || h[(5 * k + 1):(5 * k + 5)])::BIGINT // s) % 32 + 1]))), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.round_trip(pages, scratch_path(spark, "warc")).drop("intact")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
