"""The registered queries of this package and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import arc, exact_dedup, fingerprint, html_text, language, merkle, mixing, near_dedup, passages, pieces, quality, spelling, url_filter
from daygrain.llm.common import table
from daygrain.llm.mixing import SCHEDULES, _segments
from daygrain.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


@query(
    "op8_exact_dedup",
    r"""
    WITH norm AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
        FROM documents
    ), best AS (
        SELECT digest, count(*) AS group_size, arg_min(doc_id, {'short': -chars, 'id': doc_id}) AS keep_id
        FROM norm GROUP BY digest
    )
    SELECT n.doc_id, b.keep_id, b.group_size, n.doc_id = b.keep_id AS kept, n.digest AS text_sha256
    FROM norm n JOIN best b USING (digest)
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.assignments(table(spark, folder, "documents"))


def _time_sql() -> str:
    """`when_consumed` for the default schedules, as SQL over `share` and `place`."""
    cases = []
    for k, schedule in enumerate(SCHEDULES):
        steps = "".join(
            f" WHEN share < {end!r}::DOUBLE THEN {t0!r}::DOUBLE + 2.0::DOUBLE * (share - {before!r}::DOUBLE)"
            f" / ({h!r}::DOUBLE + sqrt({h * h!r}::DOUBLE + {2 * slope!r}::DOUBLE * (share - {before!r}::DOUBLE)))"
            for before, t0, h, slope, end in _segments(schedule)
        )
        cases.append(f"WHEN place % {len(SCHEDULES)} = {k} THEN CASE{steps} ELSE 1.0::DOUBLE END")
    return f"CASE {' '.join(cases)} END"


@query(
    "op5_curriculum_mix",
    rf"""
    WITH sized AS (
        SELECT doc_id, source, md5(doc_id::VARCHAR) AS draw,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
        FROM sized GROUP BY source
    ), placed AS (
        SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, 3 * source_size AS cap FROM sources
    ), levels AS (
        -- The level if exactly the sources with a smaller cap / weight stop at their caps.
        SELECT a.place, a.weight, a.cap,
               ((SELECT sum(source_size) FROM placed) - coalesce(sum(b.cap), 0))::DOUBLE
               / ((SELECT sum(weight) FROM placed) - coalesce(sum(b.weight), 0)) AS level
        FROM placed a LEFT JOIN placed b
          ON b.cap / b.weight < a.cap / a.weight OR (b.cap / b.weight = a.cap / a.weight AND b.place < a.place)
        GROUP BY a.place, a.weight, a.cap
    ), shared AS (
        SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1
    ), aimed AS (
        SELECT p.*, coalesce(least(cap::DOUBLE, (SELECT level FROM shared) * weight), cap::DOUBLE) AS target
        FROM placed p
    ), streams AS (
        SELECT s.doc_id, s.size, s.source, a.source_size, a.target, a.place,
               floor(a.target + 0.5)::BIGINT AS goal,
               (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size
                                  ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS ahead
        FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
    ), taking AS (
        SELECT *, ahead / nullif(target, 0) AS share,
               CASE WHEN source_size = 0 THEN 0 ELSE
                    (goal // source_size) * size
                    + greatest(0, least(size, goal % source_size - ahead)) END::BIGINT AS taken
        FROM streams
    )
    SELECT doc_id, size, source, source_size, target, taken,
           CASE WHEN taken > 0 THEN {_time_sql()} END AS position
    FROM taking
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with what the mix takes of them, in training order."""
    return mixing.mix(table(spark, folder, "documents")).orderBy("position", "doc_id")


@query("op3_near_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


@query("op1_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labelled = language.label(docs, language.train(docs))
    return labelled.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"),
    )


@query("op6_fingerprint")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, folder, "documents"))


@query(
    "op10_url_filter",
    rf"""
    WITH cut AS (
        SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
    ), parsed AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM cut
    ), outcomes AS (
        SELECT doc_id::VARCHAR AS id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good FROM labels GROUP BY 1
    ), rows AS (
        SELECT p.*, o.good FROM parsed p LEFT JOIN outcomes o ON regexp_extract(p.path, '/([0-9]+)(?:\.html|/)?$', 1) = o.id
    ), hosts AS (
        SELECT host, count(good) AS n, coalesce(sum(good), 0)::DOUBLE AS good,
               CASE WHEN regexp_extract(host, '([^.]*\.[^.]*)$', 1) IN ({", ".join(repr(s) for s in url_filter.TWO_LABEL_SUFFIXES)})
                    THEN 2 ELSE 1 END AS deep
        FROM rows GROUP BY host
    ), named AS (
        SELECT host, n, good,
               array_to_string(string_split(host, '.')[-(deep + 1):], '.') AS domain,
               array_to_string(string_split(host, '.')[-deep:], '.') AS suffix
        FROM hosts
    ), corpus AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 1.0) AS parent FROM named
    ), by_suffix AS (
        SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(parent) AS parent FROM named, corpus GROUP BY suffix
    ), k_suffix AS ({{k:by_suffix}}), m_suffix AS (
        SELECT suffix, (good + k * parent) / (n + k) AS parent FROM by_suffix, k_suffix
    ), by_domain AS (
        SELECT domain, suffix, sum(n) AS n, sum(good) AS good, any_value(parent) AS parent
        FROM named JOIN m_suffix USING (suffix) GROUP BY domain, suffix
    ), k_domain AS ({{k:by_domain}}), m_domain AS (
        SELECT domain, suffix, (good + k * parent) / (n + k) AS parent FROM by_domain, k_domain
    ), by_host AS (SELECT named.*, parent FROM named JOIN m_domain USING (domain, suffix)
    ), k_host AS ({{k:by_host}}), posterior AS (
        SELECT host, n + k AS size, (good + k * parent) / (n + k) AS mean FROM by_host, k_host
    ), rules(rule_host, rule_path, said) AS (
        VALUES {", ".join(map(repr, url_filter.RULES))}
    ), fitting AS (
        SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               arg_max(said, length(rule_host || rule_path)) AS said
        FROM (SELECT DISTINCT page_id, host, path FROM rows) JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY ALL
    )
    SELECT r.page_id, r.host, r.path, f.rule,
           coalesce(f.said, CASE WHEN p.mean + {url_filter.BOUND} * sqrt(p.mean * (1 - p.mean) / (p.size + 1)) < {url_filter.MIN_GOOD}
                                 THEN 'block' ELSE 'allow' END) AS verdict
    FROM rows r JOIN posterior p USING (host)
    LEFT JOIN fitting f ON f.page_id = r.page_id AND f.host = r.host AND f.path = r.path
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """A page's number in its path is the document it shows; that document's labels are its outcome."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    outcomes = labels.groupBy(F.col("doc_id").cast("string").alias("shows")).agg(F.min(good).alias("outcome"))
    _, path = url_filter.host_and_path(F.col("url"))
    shows = F.nullif(F.regexp_extract(path, r"/([0-9]+)(?:\.html|/)?$", 1), F.lit(""))
    labelled = url_filter.with_outcomes(pages, shows, outcomes)
    judged = url_filter.judge(labelled, url_filter.rule_table(spark), outcome="outcome")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _strength_sql(groups: str) -> str:
    """`url_filter._strength` over a table with n, good and parent."""
    spread = (
        "sum((good - n * parent) ** 2 - n * (parent * (1 - parent)))"
        " / nullif(sum(n * (n - 1) * (parent * (1 - parent))), 0)"
    )
    return (
        f"SELECT least(greatest(CASE WHEN spread > 0 THEN 1 / spread - 1 ELSE {url_filter.STRONGEST} END,"
        f" {url_filter.WEAKEST}), {url_filter.STRONGEST}) AS k FROM (SELECT {spread} AS spread FROM {groups})"
    )


for _level in ("by_suffix", "by_domain", "by_host"):
    ORACLES["op10_url_filter"] = ORACLES["op10_url_filter"].replace(f"{{k:{_level}}}", _strength_sql(_level))


@query("op9_pieces")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's ids, decoded again: `round_trip` says that the decoded text is the text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = pieces.decode_column(pieces.encode(docs))
    return decoded.select(
        "doc_id", F.size("ids").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query("op2_html_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op7_repeated_passages")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII or Latin-1 text's UTF-8 bytes, bit by bit."""
    values = f"[('0x' || hex({text})[2 * i - 1 : 2 * i])::BIGINT FOR i IN range(1, strlen({text}) + 1)]"
    steps = f"flatten([[v, -1, -1, -1, -1, -1, -1, -1, -1] FOR v IN {values}])"
    turn = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {turn}), 4294967295)"


def _tree_sql(name: str, start: str, levels: int) -> str:
    """`{name}_run_k` and `{name}_top` over `start` (tree, i, d, size)."""
    text = f"{name}_0 AS MATERIALIZED ({start})"
    for k in range(levels):
        text += f""", {name}_run_{k} AS MATERIALIZED (
        SELECT tree, i // {merkle.ARITY} AS i, list(d ORDER BY i) AS run, (any_value(size) + {merkle.ARITY - 1}) // {merkle.ARITY} AS size
        FROM {name}_{k} WHERE size > 1 GROUP BY tree, i // {merkle.ARITY}
    ), {name}_{k + 1} AS MATERIALIZED (SELECT tree, i, sha256(array_to_string(run, '')) AS d, size FROM {name}_run_{k})"""
    tops = " UNION ALL ".join(f"SELECT tree, d FROM {name}_{k} WHERE size = 1" for k in range(levels + 1))
    return f"{text}, {name}_top AS MATERIALIZED ({tops})"


def _fold_sql(name: str, start: str, levels: int) -> str:
    """Folds `start` (..., tree, i, proof, node) along the runs, to `{name}_up_{levels}`."""
    text = f"{name}_up_0 AS MATERIALIZED ({start})"
    slot = f"u.i % {merkle.ARITY}"
    for k in range(levels):
        text += f""", {name}_up_{k + 1} AS MATERIALIZED (
        SELECT u.* REPLACE (
            u.i // {merkle.ARITY} AS i,
            u.proof || CASE WHEN run IS NULL THEN '' ELSE array_to_string(run[:{slot}] || run[{slot} + 2:], '') END AS proof,
            CASE WHEN run IS NULL THEN node ELSE
                 sha256(array_to_string(list_append(run[:{slot}], node) || run[{slot} + 2:], '')) END AS node)
        FROM {name}_up_{k} u LEFT JOIN {name}_run_{k} r ON r.tree = u.tree AND r.i = u.i // {merkle.ARITY}
    )"""
    return text


def _leaf_sql(text: str) -> str:
    one = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(one.format(text if f == "text" else f) for f in merkle.FIELDS) + ")"


# The levels suffice for 16 ** 6 rows of a source and 16 ** 4 sources.
@query(
    "op13_merkle_manifest",
    rf"""
    WITH leaves AS MATERIALIZED (
        SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 5 = 0
                    THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                    ELSE {_leaf_sql("text")} END AS shown
        FROM documents
    ), placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               count(*) OVER (PARTITION BY tree) AS size
        FROM leaves
    ), {_tree_sql("source", "SELECT tree, i, leaf AS d, size FROM placed", 6)},
    {_tree_sql("whole", "SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, d, count(*) OVER () AS size FROM source_top", 4)},
    {_fold_sql("source", "SELECT *, '' AS proof, shown AS node FROM placed", 6)},
    {_fold_sql("whole", "SELECT u.* REPLACE ('' AS tree, s.i AS i), u.tree AS of FROM source_up_6 u JOIN (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i FROM source_top) s USING (tree)", 4)}
    SELECT u.doc_id, u.leaf, t.d AS subroot, w.d AS root, sha256(u.proof) AS proof_sha256,
           u.node AS folded_root, u.node = w.d AS verified
    FROM whole_up_4 u JOIN source_top t ON t.tree = u.of, whole_top w
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Where 5 divides the CRC-32 of the id, the text is presented with A-Z in lower case."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(tampered, lowered).otherwise(F.col("text"))
    return merkle.verified(merkle.manifest(table(spark, folder, "documents"), presented={"text": shown}))


@query(
    "op12_warc",
    f"""
    WITH payloads AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
    ), placed AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM payloads
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {arc.MIN_REVISIT} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {arc.MIN_REVISIT} AND page_id <> last THEN last END AS refers_to
    FROM placed
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = arc.archived(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# A word without its letter in each place: one letter less, or one replaced where the place is the same.
@query(
    "op11_spelling",
    rf"""
    WITH runs AS MATERIALIZED (
        SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS raw FROM documents)
        GROUP BY ALL
    ), coded AS MATERIALIZED (
        SELECT run, times, {_crc32_sql("(doc_id::VARCHAR || ':' || run)")} AS h FROM runs
    ), words AS MATERIALIZED (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
               sum(times)::BIGINT AS n
        FROM coded GROUP BY 1 HAVING length(word) >= {spelling.MIN_LENGTH} AND sum(times) >= {spelling.MIN_COUNT}
    ), less AS MATERIALIZED (
        SELECT word, length(word) AS size, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
    ), pairs AS MATERIALIZED (
        SELECT a.word, b.word AS near FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
        UNION SELECT w.word, l.word FROM words w JOIN less l ON l.rest = w.word
        UNION SELECT l.word, w.word FROM words w JOIN less l ON l.rest = w.word
    ), best AS (
        SELECT p.word, count(*) AS n_near, first(p.near ORDER BY w.n DESC, p.near) AS near, max(w.n) AS near_n
        FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word
    ), formed AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.LIFT} * w.n THEN near END AS form,
               CASE WHEN near_n >= {spelling.LIFT} * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), walk AS (
        WITH RECURSIVE steps(word, stop) AS (
            SELECT word, word FROM formed UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.stop WHERE f.form IS NOT NULL
        ) SELECT s.word, s.stop AS root FROM steps s JOIN formed f ON f.word = s.stop WHERE f.form IS NULL
    )
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN walk USING (word)
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Where 199 divides the CRC-32 of `<doc_id>:<word>`, the occurrence has lost a letter."""
    return spelling.variants(table(spark, folder, "documents"), every=199, edit=spelling.one_letter_less)
