"""The registered queries of the operators and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions import scratch_path
from surveyloom.llm import (
    bpe, decontaminate, interpolation, licences, lines, neighbours, personal_data, pieces, simhash, spelling, token_files, toxicity,
    vector_codes,
)
from surveyloom.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, net)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "worst_token")


LINE_DEDUP_SQL = """
with lines as (
  select doc_id, line, pos,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
    from documents
  )
), frequent as (
  select key, max(doc_id) as keeper from lines where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
)
select doc_id, count(*) as n_lines, count(*) filter (where doc_id < keeper) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where keeper is null or doc_id = keeper), '')) as kept_sha256
from lines left join frequent using (key) group by doc_id
"""


@query("op2_line_dedup", LINE_DEDUP_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.piece_digests(table(spark, sf_dir, "documents"), model)


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path
    )
    return token_files.read_token_files(spark, path)


@query("op3_interpolated_lm")
def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_documents(table(spark, sf_dir, "documents"))


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


@query("op9_licences")
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op5_nn_descent")
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op11_prefix_bpe")
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_spelling_groups")
def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"))
    return spelling.group_spellings(words).select("word", "root", "form", "n", "n_near", "form_n")


def vector_codes_sql(rounds: int = 4) -> str:
    """The rounds written out one after the other; distances from inner products, exact in doubles here."""
    nearest = """
a{r} as (
  select x.vec_id, x.p, min(struct_pack(d := list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, b.x)
    + list_inner_product(b.x, b.x), e := b.e)) as best
  from parts x join b{r} b using (p) group by x.vec_id, x.p
)"""
    update = """
s{r} as (
  select x.p, a.best.e as e, pos, count(*) as c, cast(sum(x.x[pos]) as bigint) as s
  from parts x join a{r} a using (vec_id, p), range(1, 17) t(pos) group by x.p, a.best.e, pos
), m{r} as (
  select p, e, list(cast((s - ((s % c) + c) % c) // c as double) order by pos) as x from s{r} group by p, e
), b{n} as (
  select b.p, b.e, coalesce(m.x, b.x) as x from b{r} b left join m{r} m on m.p = b.p and m.e = b.e
)"""
    steps = [nearest.format(r=r) + "," + update.format(r=r, n=r + 1) for r in range(rounds)] + [nearest.format(r=rounds)]
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select vec_id, p, v[p * 16 + 1 : p * 16 + 16] as x from kept, range(4) t(p)
), b0 as (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, x from parts
  qualify row_number() over (partition by p order by vec_id) <= 256
),{",".join(steps)}, coded as (
  select vec_id, string_agg(format('{{:02x}}', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from a{rounds} group by vec_id
), books as (
  select sha256(string_agg(cast(cast(x[pos] as bigint) as varchar), ',' order by p, e, pos)) as codebooks_sha256
  from b{rounds}, range(1, 17) t(pos)
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (vec_id), books
"""


@query("op13_vector_codes", vector_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).drop("label")
