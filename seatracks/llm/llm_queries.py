"""The queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .bpe_stream import encode_and_decode
from .conversation_repair import damaged_and_repaired
from .exact_dedup import exact_duplicates
from .gif_media import media_features, store_media
from .katz_lm import katz_scores
from .merkle import tampering_found
from .near_dedup import near_duplicates
from .packing import pack
from .quality_rules import quality_rules
from .secret_scan import scan_secrets
from .sharding import shard_by_bytes
from .simple8b import read_token_files, write_token_files
from .substring_dedup import substring_dedup

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(common.load(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans", "n_lexed")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.load(spark, sf_dir), common.tokenizer_path(WORD_BPE), size=2048)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(common.load(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.shared_dir(spark) + "/tokens"
    write_token_files(common.load(spark, sf_dir), path, common.tokenizer_path(BYTE_BPE), end_id=0)
    return read_token_files(spark, path)


def op5_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(common.load(spark, sf_dir), order=3)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.load(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(common.load(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encode_and_decode(common.load(spark, sf_dir), common.tokenizer_path(WORD_BPE))
    return both.select("doc_id", "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(common.load(spark, sf_dir), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media_features(common.written(store_media(common.load(spark, sf_dir)), common.shared_dir(spark) + "/media"))
    # frames, time, colours, and a digest of the timed frames with each one's colours
    feature = F.concat_ws(";", F.col("n_frames").cast("string"), F.col("duration_cs").cast("string"), F.concat_ws(",", F.col("histogram").cast("array<string>")), F.hex(F.xxhash64("frames")))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(common.load(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(common.load(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampering_found(common.load(spark, sf_dir))


OPERATORS = (
    op1_secret_scan, op2_best_fit_packing, op3_quality_rules, op4_token_files, op5_katz_lm, op6_minhash_near_dedup, op7_substring_dedup,
    op8_bpe_stream, op9_sharding, op10_gif_media, op11_exact_dedup, op12_conversation_repair, op13_merkle_manifest,
)

ORACLES = {
    "op11_exact_dedup": r"""SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents) WINDOW g AS (PARTITION BY t)""",
    # crc32 by its table, levels by recursion, then each leaf's siblings
    "op13_merkle_manifest": r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce('=' || source, '') AS g, text, CASE WHEN list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS bad,
concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END, CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END, CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END, CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS head FROM documents, crc),
e AS (SELECT doc_id, g, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf, sha256(head || CASE WHEN bad IS NULL THEN '-' ELSE strlen(bad) || ':' || bad END) AS bad FROM d),
leaves AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY g) AS m FROM e WINDOW w AS (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf)),
lv(lev, g, pos, h, m) AS (SELECT 0, g, pos, leaf, m FROM leaves UNION ALL SELECT lev + 1, g, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 2) // 3 FROM lv WHERE m > 1 GROUP BY lev, g, pos // 3),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS m FROM lv WHERE m = 1),
rt(lev, pos, h, m) AS (SELECT 0, pos, h, m FROM sub UNION ALL SELECT lev + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 2) // 3 FROM rt WHERE m > 1 GROUP BY lev, pos // 3),
ups AS (SELECT l.g, l.pos, s.lev, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < l.pos // (3 ** s.lev)::BIGINT), '') AS lo, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > l.pos // (3 ** s.lev)::BIGINT), '') AS hi
FROM leaves l JOIN lv s ON s.g = l.g AND s.m > 1 AND s.pos // 3 = l.pos // (3 ** (s.lev + 1))::BIGINT GROUP BY l.g, l.pos, s.lev),
tops AS (SELECT l.g, s.lev, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < l.pos // (3 ** s.lev)::BIGINT), '') AS lo, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > l.pos // (3 ** s.lev)::BIGINT), '') AS hi
FROM sub l JOIN rt s ON s.m > 1 AND s.pos // 3 = l.pos // (3 ** (s.lev + 1))::BIGINT GROUP BY l.g, s.lev),
low AS (SELECT g, pos, list(lo || '.' || hi ORDER BY lev) AS p FROM ups GROUP BY g, pos), high AS (SELECT g, list(lo || '.' || hi ORDER BY lev) AS p FROM tops GROUP BY g),
paths AS (SELECT l.*, s.h AS subroot, (SELECT h FROM rt WHERE m = 1) AS root, list_concat(coalesce(low.p, []), coalesce(high.p, [])) AS p FROM leaves l JOIN sub s ON s.g = l.g LEFT JOIN low ON low.g = l.g AND low.pos = l.pos LEFT JOIN high ON high.g = l.g),
done AS (SELECT *, sha256(replace(array_to_string(p, ''), '.', '')) AS proof_sha256, list_reduce(list_prepend(bad, p), lambda a, s: sha256(split_part(s, '.', 1) || a || split_part(s, '.', 2))) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done""",
}


def queries() -> dict:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return ORACLES
