"""The registered queries of this package, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierloom.llm import ann, bpe, cross_tokens, exact_dedup, html_text, langid, merkle, mixing, near_dedup, ngram_lm, sharding, token_counts, url_filter
from tierloom.llm.shared import read
from tierloom.session import configure

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)
# Pages with more than one link for so many characters make up the list of the URL filter.
CHARACTERS_PER_LINK = 180


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests; nulls and blanks have no tokens."""
    return bpe.encoded_digests(read(configure(spark), sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page: the longest rule that fits, else the list; a null URL is allowed."""
    pages = read(configure(spark), sf_dir, "pages")
    return url_filter.judge(pages, RULES, url_filter.urls_of_link_pages(pages, CHARACTERS_PER_LINK))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out; `und` without a letter."""
    found = langid.identified(read(configure(spark), sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector; vectors without a direction take no part, ties go to the smaller id."""
    found = ann.nearest(read(configure(spark), sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by links of 80 % of its 2-word shingles; a document without words stands alone."""
    found = near_dedup.near_duplicates(read(configure(spark), sf_dir, "documents"), words=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and checksum of every document in 16 equal shards; a null text has size 1."""
    return sharding.sharded(read(configure(spark), sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; a null or blank text has none."""
    found = mixing.mix(read(configure(spark), sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; crossing tokens go by the stated rule."""
    docs = read(configure(spark), sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN).drop("at")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stands for every document with the same normalised text; a null text counts as empty."""
    found = exact_dedup.exact_duplicates(read(configure(spark), sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the model and by single words; a null text is one end token."""
    return ngram_lm.score(read(configure(spark), sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; a null or textless page has the empty text."""
    found = html_text.main_text(read(configure(spark), sf_dir, "pages"))
    text = F.array_join("blocks", "\n\n")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by language; a third of the leaves are checked with their text in lower case."""
    docs = read(configure(spark), sf_dir, "documents")
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.verified(docs, {"text": text}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)


def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between byte-level and piece tokens of every document, and how common the linked pairs are."""
    docs = read(configure(spark), sf_dir, "documents")
    return cross_tokens.align(docs, public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_url_filter,
        op3_language_id,
        op4_nearest_vectors,
        op5_near_dedup,
        op6_sharding,
        op7_mixing,
        op8_token_counts,
        op9_exact_dedup,
        op10_lm_score,
        op11_html_text,
        op12_merkle,
        op13_cross_tokens,
    )
}

_HOST = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')"
_CANONICAL = r"""case when host <> '' then regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
      || case when kept <> '' then '?' || kept else '' end end"""

_FIELD = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, i + 1, 1))::bigint)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

ORACLES = {
    "op2_url_filter": rf"""
with parsed as (
  select page_id, url, html, translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path,
    array_to_string(list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&') as kept
  from pages),
named as (select *, {_CANONICAL} as canonical from parsed),
rules(rule_host, rule_path, rule_verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits as (
  select named.*, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from named left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)),
bad as (select distinct canonical from named
  where canonical is not null and (length(html) - length(replace(html, '<a ', ''))) / 3 * {CHARACTERS_PER_LINK} > length(html))
select page_id, host, path, rule,
  coalesce(rule_verdict, case when canonical in (select canonical from bad) then 'block' else 'allow' end) as verdict,
  canonical, rule is null and coalesce(canonical in (select canonical from bad), false) as listed
from fits where place = 1""",
    "op9_exact_dedup": r"""
with plain as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by norm order by doc_id) = 1 as kept, sha256(norm) as text_sha256
from plain window same as (partition by norm)""",
    "op12_merkle": f"""
with recursive leaves as (
  select doc_id, {_leaf("text")} as leaf,
    case when {_CRC32} % 3 = 0 then {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as tampered,
    dense_rank() over (order by lang nulls first) - 1 as tree,
    row_number() over (partition by lang order by doc_id) - 1 as pos, count(*) over (partition by lang) as n
  from documents),
low(tree, height, pos, n, hash) as (
  select tree, 0, pos, n, leaf from leaves
  union all
  select tree, height + 1, pos // 8, (n + 7) // 8, sha256(string_agg(hash, '' order by pos)) from low where n > 1 group by tree, height, pos // 8, n),
subroots as (select tree, hash as subroot, count(*) over () as n from low where n = 1),
high(height, pos, n, hash) as (
  select 0, tree, n, subroot from subroots
  union all
  select height + 1, pos // 8, (n + 7) // 8, sha256(string_agg(hash, '' order by pos)) from high where n > 1 group by height, pos // 8, n),
runs as (
  select tree, height, pos // 8 as run, string_agg(hash, '' order by pos) as children from low where n > 1 group by all
  union all
  select -1, height, pos // 8, string_agg(hash, '' order by pos) from high where n > 1 group by all),
inside(doc_id, tree, height, pos, n, folded, siblings) as (
  select doc_id, tree, 0, pos, n, coalesce(tampered, leaf), '' from leaves
  union all
  select doc_id, tree, height + 1, pos // 8, (n + 7) // 8,
    sha256(substr(children, 1, 64 * (pos % 8)) || folded || substr(children, 64 * (pos % 8) + 65)),
    siblings || substr(children, 1, 64 * (pos % 8)) || substr(children, 64 * (pos % 8) + 65)
  from inside join runs using (tree, height) where n > 1 and run = pos // 8),
above(doc_id, tree, height, pos, n, folded, siblings) as (
  select doc_id, tree, 0, tree, s.n, folded, siblings from inside join subroots s using (tree) where inside.n = 1
  union all
  select doc_id, above.tree, above.height + 1, pos // 8, (n + 7) // 8,
    sha256(substr(children, 1, 64 * (pos % 8)) || folded || substr(children, 64 * (pos % 8) + 65)),
    siblings || substr(children, 1, 64 * (pos % 8)) || substr(children, 64 * (pos % 8) + 65)
  from above join runs on runs.tree = -1 and runs.height = above.height and run = pos // 8 where n > 1)
select doc_id, leaf, subroot, hash as root, sha256(siblings) as proof_sha256, folded as folded_root, folded = hash as verified
from above join leaves using (doc_id) join subroots on subroots.tree = leaves.tree cross join high where above.n = 1 and high.n = 1""",
}
