"""One query per operator over its whole table, with SQL where it can state the result."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.llm import (
    byte_bpe, exact_dedup, filter_audit, language_id, line_dedup, merkle, nearest, packing, simhash, token_counts,
    toxicity, url_rules, warc,
)
from tenderlens.llm.common import ascii_lower, table

QUERIES = {}
ORACLES = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@_query()
def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, F.col("vec_id") % 50 == 0)


@_query("""
with source as (select doc_id, text, unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as n from documents),
lines as (select * from source where regexp_matches(line, '[^ \\t\\n\\v\\f\\r]')),
ranked as (select *, row_number() over (partition by line order by doc_id, n) as copy from lines),
firsts as (select line, doc_id, n, row_number() over (order by doc_id, n) as o from ranked where copy = 1),
halves as (
  select o, line, unnest([length(line) // 2, (length(line) + 1) // 2]) as c from firsts),
keys as (
  select distinct o, line, unnest([c || ' < ' || left(line, greatest(c - 1, 0)), c || ' > ' || right(line, c)]) as key
  from halves),
met as (
  select distinct b.o, a.line as early, b.line as late
  from keys a join keys b on a.key = b.key and a.o < b.o and abs(length(a.line) - length(b.line)) <= 1),
gone as (
  select distinct o from met where
    (length(early) = length(late) and exists (select 1 from range(length(late)) t(i)
        where left(early, i::int) = left(late, i::int) and substr(early, i::int + 2) = substr(late, i::int + 2)))
    or (length(early) < length(late) and exists (select 1 from range(length(late)) t(i)
        where early = left(late, i::int) || substr(late, i::int + 2)))
    or (length(early) > length(late) and exists (select 1 from range(length(early)) t(i)
        where late = left(early, i::int) || substr(early, i::int + 2)))),
stay as (select doc_id, n from firsts where o not in (select o from gone)),
marked as (
  select s.doc_id, s.n, s.line, regexp_matches(s.line, '[^ \\t\\n\\v\\f\\r]') as counts, stay.n is not null as stays
  from source s left join stay on s.doc_id = stay.doc_id and s.n = stay.n),
done as (
  select doc_id, count(*) filter (counts) as n_lines, count(*) filter (counts and not stays) as n_removed,
    coalesce(string_agg(line, chr(10) order by n) filter (stays or not counts), '') as left_over
  from marked group by doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  case when d.text is null then null else sha256(left_over) end as text_sha256
from documents d left join done using (doc_id)
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those that repeat an earlier one, and a digest of the rest."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@_query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the bytes that they decode to."""
    return byte_bpe.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from three quarters of the documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit(docs, ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.predict(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


@_query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=3)
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), hexadecimal.alias("fingerprint"), "component_id")


@_query("""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages),
best as (
  select payload_bytes, payload_digest, max(page_id) as best from p where payload_bytes >= 1000 group by all)
select page_id, payload_bytes, payload_digest,
  case when best <> page_id then 'revisit' else 'response' end as record_type,
  case when best <> page_id then best end as refers_to
from p left join best using (payload_bytes, payload_digest)
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What archives of all pages hold after writing and reading them."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@_query("""
with p as (
  select page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(r_host, r_path, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
  select p.*, r_host || r_path as rule, verdict, row_number() over (
    partition by page_id order by length(r_host || r_path) desc nulls last) as n
  from p left join rules on ('.' || host) like ('%.' || r_host) and starts_with(path, r_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where n = 1
""")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict of every page's address."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@_query("""
with d as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
  text_sha256
from d window w as (partition by text_sha256)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query("""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') as words
  from documents),
failed as (
  select doc_id, part,
    (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as f
  from d),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
masks as (
  select part, f, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as t
  from failed left join l using (doc_id) group by part, f),
letters(letter, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
  from letters a, letters b, letters c, letters d, letters e where a.b | b.b | c.b | d.b | e.b = 31),
steps as (
  select filter_order, step::int as step, bits[step] as own, list_sum(bits[1:step - 1])::int as earlier
  from (select *, unnest([1, 2, 3, 4, 5]) as step from orders)),
own_steps as (select filter_order, step, own, coalesce(earlier, 0) as earlier from steps),
done as (
  select part, filter_order, step, own,
    coalesce(sum(n) filter (f & (earlier | own) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (f & earlier = 0 and f & own > 0), 0)::bigint as removed,
    coalesce(sum(n) filter (f & earlier > 0 and f & own > 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (f = own), 0)::bigint as unique_fails,
    coalesce(sum(g) filter (f & earlier = 0 and f & own > 0), 0)::bigint as good_lost,
    coalesce(sum(t) filter (f & earlier = 0 and f & own > 0), 0)::bigint as toxic_lost
  from masks, own_steps group by part, filter_order, step, own)
select * exclude (own), (sum(removed) over (partition by part, own))::bigint as shapley from done
""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every language, at every step of every order."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("""
with recursive
crcs as (
  select *, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) as crc
  from documents),
texts as (
  select *, case when crc % 3 = 0 then
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as changed,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
  from crcs),
digests as (
  select doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) as shown from texts),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as spot,
    count(*) over (partition by lang) as size, dense_rank() over (order by lang nulls first) - 1 as tree from digests),
tree(tree, level, spot, size, node) as (
  select tree, 0, spot, size, leaf from leaves
  union all
  select tree, level + 1, spot // 8, (size + 7) // 8, sha256(string_agg(node, '' order by spot))
  from tree where size > 1 group by tree, level, spot // 8, size),
subroots as (select tree as spot, node from tree where size = 1),
top(level, spot, size, node) as (
  select 0, spot, (select count(*) from subroots), node from subroots
  union all
  select level + 1, spot // 8, (size + 7) // 8, sha256(string_agg(node, '' order by spot))
  from top where size > 1 group by level, spot // 8, size),
root as (select node as root from top where size = 1),
ways as (
  select l.tree, l.spot, t.level, t.spot as place, node, l.spot // (8 ** t.level)::bigint as own
  from leaves l join tree t on t.tree = l.tree and t.size > 1 and t.spot // 8 = l.spot // (8 ** (t.level + 1))::bigint
  union all
  select l.tree, l.spot, 1000 + t.level, t.spot, node, l.tree // (8 ** t.level)::bigint
  from leaves l join top t on t.size > 1 and t.spot // 8 = l.tree // (8 ** (t.level + 1))::bigint),
sides as (
  select tree, spot, row_number() over (partition by tree, spot order by level) as step,
    coalesce(string_agg(node, '' order by place) filter (place < own), '') as before,
    coalesce(string_agg(node, '' order by place) filter (place > own), '') as after
  from ways group by tree, spot, level),
fold(tree, spot, step, node) as (
  select tree, spot, 0, shown from leaves
  union all
  select f.tree, f.spot, f.step + 1, sha256(before || node || after)
  from fold f join sides s on s.tree = f.tree and s.spot = f.spot and s.step = f.step + 1),
ends as (select tree, spot, arg_max(node, step) as folded_root from fold group by tree, spot),
proofs as (
  select tree, spot, sha256(string_agg(before || after, '' order by step)) as proof_sha256 from sides group by tree, spot)
select doc_id, leaf, s.node as subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root,
  folded_root = root as verified
from leaves l join subroots s on s.spot = l.tree cross join root join ends e on e.tree = l.tree and e.spot = l.spot
  left join proofs p on p.tree = l.tree and p.spot = l.spot
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the document as shown still verifies."""
    docs = table(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = F.when(changed, merkle.leaf(*head, ascii_lower(F.col("text"))))
    found = merkle.proofs(docs, merkle.leaf(*head, F.col("text")), presented=shown)
    found = found.withColumn("folded", merkle.folded(F.coalesce("presented", "leaf"), F.col("proof")))
    return found.select(
        F.col("id").alias("doc_id"), *[merkle.hexadecimal(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        merkle.hexadecimal(merkle.proof_digest(F.col("proof"))).alias("proof_sha256"),
        merkle.hexadecimal(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


@_query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every whole text is, learned from the labels of four fifths of the documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
