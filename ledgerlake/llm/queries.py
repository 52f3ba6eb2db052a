"""The operators of this package over the supplied tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.storage import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from ledgerlake.llm.packing import pack, piece_rows

    return piece_rows(pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.toxicity import held_out, scored, train

    documents = table(spark, folder, "documents")
    model = train(documents, table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    rows = scored(documents.select("doc_id", "text"), model)
    # Offending sentences as start:end:score, in code points.
    places = F.transform("sentences", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"), F.format_number(s["score"], 3)))
    return rows.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted", F.array_join(places, ",").alias("sentences"))


@query
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, folder, "documents"), words=4, percent=80)


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.decontamination import contamination

    documents = table(spark, folder, "documents").select("doc_id", "text")
    rows = contamination(documents, table(spark, folder, "benchmark"))
    return rows.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ANSWERS["op6_decontamination"] = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as v
  from (select item, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)
), places as (
  select doc_id, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) as i
  from words, (select distinct n from windows)
), found as (
  select distinct doc_id, i, p.n, item
  from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as v from places) p join windows using (n, v)
), hit as (
  select doc_id, count(distinct k) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as k from found) group by doc_id
), listed as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (select distinct doc_id, item from found) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join listed using (doc_id)
"""


@query
def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.secrets import KINDS, listed, scan

    rows = scan(table(spark, folder, "documents").select("doc_id", "text"))
    # Once computed, a row's spans are used by several columns.
    rows = rows.select("row.doc_id", F.explode(F.array("spans")).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id",
        *(count(k) for k in ("assign", "access", "hex")),
        F.sha2(listed(F.col("spans"), 3), 256).alias("base_sha256"),
        listed(F.col("spans"), len(KINDS)).alias("spans"),
    )


#: The rules of the URL query (fixed values): host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.urls import judged

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judged(table(spark, folder, "pages").select("page_id", "url"), rules)


ANSWERS["op7_url_filters"] = r"""
with parts as (
  select page_id, row_number() over () as place,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages
), rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select place, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as verdict
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by place
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join fits using (place)
"""


@query
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.repeats import kept_bytes, repeats

    rows = kept_bytes(repeats(table(spark, folder, "documents").select("doc_id", "text")))
    n_bytes = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    return rows.select(
        "row.doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # The removed runs as start:end, in bytes.
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


@query
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from ledgerlake.llm.chat import digests, formatted

    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(formatted(given.unionByName(more), public_tokenizers.path("word_bpe_49k.json")))


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.neighbours import nearest

    return nearest(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


@query
def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.pii import with_surrogates

    # The key is an argument of the run; whoever knows it can tell which surrogate stands for a guessed entity.
    key = spark.conf.get("spark.ledgerlake.surrogates.key", "surrogates of this corpus")
    rows = with_surrogates(table(spark, folder, "documents").select("doc_id", "text"), key=key.encode()[:64])
    spans = F.transform("replaced", lambda r: F.concat_ws(":", r["kind"], r["start"].cast("string"), r["end"].cast("string")))
    return rows.select("row.doc_id", F.col("new_text").alias("text"), F.size("replaced").cast("long").alias("n_replaced"), F.array_join(spans, ",").alias("replaced"))


@query
def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.quality import held_out, scored, train

    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    return scored(documents, model).select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted")


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, label, positives=5, negatives=3, low=50, high=95)


ANSWERS["op13_hard_negatives"] = """
with given as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint as score
  from given a join given b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), fits as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scored s using (anchor_id)
  where not s.same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from fits where rank <= 3
"""


@query
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from ledgerlake.llm.manifest import manifest

    names = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = {c: F.col(c) for c in names}
    more = columns | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = manifest(table(spark, folder, "documents").select(*names), columns["doc_id"], columns["lang"], list(columns.values()), list(more.values()), chosen)
    return rows.withColumnRenamed("id", "doc_id")


ANSWERS["op11_manifest"] = """
with recursive fields as (
  select doc_id, lang, n_chars, [doc_id::varchar, source, lang, n_chars::varchar, text] as own,
         [doc_id::varchar, source, lang, (n_chars::hugeint + 1)::varchar, text] as changed,
         -- the checksum, bit by bit: a byte is taken in, then eight shifts
         xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda c, o: case when o >= 0 then xor(c, o) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295) as crc
  from documents
), leaves as (
  select doc_id, lang, sha256(array_to_string(list_transform(own, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) as leaf,
         sha256(array_to_string(list_transform(case when crc % 7 = 0 then changed else own end, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) as seen
  from fields
), places as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from leaves
), tree as (
  select lang, 0 as level, list(leaf order by place) as nodes from places group by lang
  union all
  select lang, level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) from tree where len(nodes) > 1
), subroots as (
  select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as place from tree where len(nodes) = 1
), up as (
  select 0 as level, list(subroot order by place) as nodes from subroots
  union all
  select level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) from up where len(nodes) > 1
), rows as (
  select p.*, s.subroot, s.place as tree_place, row_number() over () as number from places p join subroots s on p.lang is not distinct from s.lang
), steps as (
  select number, level, (place >> level) % 2 as side, coalesce(nodes[xor(place >> level, 1) + 1], '') as sibling
  from rows join tree on rows.lang is not distinct from tree.lang where len(nodes) > 1
  union all
  select number, 1000 + level, (tree_place >> level) % 2, coalesce(nodes[xor(tree_place >> level, 1) + 1], '') from rows, up where len(nodes) > 1
), lists as (
  select number, string_agg(sibling, '' order by level) as joined, list(side || sibling order by level) as path from steps group by number
), done as (
  select doc_id, leaf, subroot, (select nodes[1] from up where len(nodes) = 1) as root, sha256(coalesce(joined, '')) as proof_sha256,
         list_reduce([seen] || coalesce(path, []), lambda a, s: case when s[1] = '1' then sha256(s[2:] || a) else sha256(a || s[2:]) end) as folded_root
  from rows left join lists using (number)
)
select *, folded_root = root as verified from done
"""
