"""One query per operator, over its whole table with production parameters.

The Merkle manifest and exact dedup have SQL (``ORACLES``). Models, tokens and fingerprints have no
counterpart in SQL; the tests compare these with brute force, round trips and held-out labels.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, exact_dedup, langid, line_dedup, merkle, neighbours, packing, quality, simhash, token_counts, toxicity, urls, whitening

BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The rules that the query judges by.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BPE_JSON)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BPE_JSON)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs, counts=True).select("doc_id", "n_lines", "n_removed", "text")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), BPE_RANKS)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    forged = {"text": F.when(third, merkle.lower_case(F.col("text")))}
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=forged).drop("path")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_packing,
        op3_toxicity,
        op4_token_counts,
        op5_quality_rules,
        op6_simhash,
        op7_line_dedup,
        op8_byte_bpe,
        op9_neighbours,
        op10_language_id,
        op11_merkle,
        op12_whitening,
        op13_exact_dedup,
    )
}


def _field(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar))||':'||cast({value} as varchar),'-')"


def _leaf(text: str) -> str:
    return f"sha256({'||'.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_MERKLE = f"""
with recursive docs as (
  select *, case when lang is null then '0' else '1'||lang end as g,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar),''), lambda c: ord(c)::bigint)),
      lambda c, b: list_reduce(list_prepend(xor(c,b), [0,0,0,0,0,0,0,0]::bigint[]), lambda x, z: xor(x>>1, (x&1)*3988292384)))) as crc
  from documents),
leaves as (
  select doc_id, g, {_leaf('text')} as leaf, row_number() over (partition by g order by doc_id)-1 as idx, count(*) over (partition by g) as n,
    case when crc%3=0 then {_leaf("translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')")} else {_leaf('text')} end as forged
  from docs),
tree(g, level, idx, hash, n) as (
  select g, 0, idx, leaf, n from leaves
  union all
  select g, level+1, idx//8, sha256(string_agg(hash,'' order by idx)), (max(n)+7)//8 from tree where n>1 group by g, level, idx//8),
tops as (select g, hash, row_number() over (order by g)-1 as idx, count(*) over () as n from tree where n=1),
crown(level, idx, hash, n) as (
  select 0, idx, hash, n from tops
  union all
  select level+1, idx//8, sha256(string_agg(hash,'' order by idx)), (max(n)+7)//8 from crown where n>1 group by level, idx//8),
runs as (
  select g, level, idx//8 as run, list(hash order by idx) as hashes from tree where n>1 group by g, level, idx//8
  union all
  select '', level+100, idx//8, list(hash order by idx) from crown where n>1 group by level, idx//8),
places as (
  select l.doc_id, l.g, l.leaf, l.forged, t.hash as subroot, l.idx as at, t.idx as top
  from leaves l join tops t using (g)),
steps as (
  select p.doc_id, r.level, r.hashes, (p.at//cast(pow(8,r.level) as bigint))%8 as place
  from places p join runs r on r.g=p.g and r.level<100 and r.run=p.at//cast(pow(8,r.level+1) as bigint)
  union all
  select p.doc_id, r.level, r.hashes, (p.top//cast(pow(8,r.level-100) as bigint))%8
  from places p join runs r on r.level>=100 and r.run=p.top//cast(pow(8,r.level-99) as bigint)),
paths as (
  select doc_id, list({{'b': array_to_string(hashes[1:place],''), 'a': array_to_string(hashes[place+2:],'')}} order by level) as path
  from steps group by doc_id),
folded as (
  select p.*, (select hash from crown where n=1) as root, sha256(coalesce(array_to_string(list_transform(path, lambda s: s.b||s.a),''),'')) as proof_sha256,
    list_reduce(list_prepend({{'b': forged, 'a': ''}}, coalesce(path,[])), lambda x, y: {{'b': sha256(y.b||x.b||y.a), 'a': ''}}).b as folded_root
  from places p left join paths using (doc_id))
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root=root as verified from folded
"""
_EXACT = r"""
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size, doc_id=min(doc_id) over same as kept, sha256(plain) as text_sha256
from (select doc_id, regexp_replace(coalesce(text,''), '[\x20\x09-\x0D]+', ' ', 'g') as plain from documents)
window same as (partition by plain)
"""
ORACLES: dict[str, str] = {"op11_merkle": _MERKLE, "op13_exact_dedup": _EXACT}
