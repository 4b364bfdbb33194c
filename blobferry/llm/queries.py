"""Registered queries of the ten operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blobferry.llm import (decontaminate, fill_middle, language, lattice, line_dedup, merkle, packing, quality,
                           secrets, simhash, token_counts, token_files, warc)
from blobferry.llm.encoder import CACHE_PIECES

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), path_col="source")


def op2_lattice(spark, sf_dir):
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_lines(spark, sf_dir):
    """Every document with its repeated lines taken out."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_token_files(spark, sf_dir):
    rows = token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_packing(spark, sf_dir):
    rows = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), window=1024, end_id=0,
                        cached_pieces=CACHE_PIECES)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                       "offset")


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op7_warc(spark, sf_dir):
    rows = warc.archive_pages(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontaminate(spark, sf_dir):
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_quality(spark, sf_dir):
    """Host: the source; path: the language section of the source."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = quality.judge(docs.select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("path")),
                         model, host_col="source", path_col="path", keep=["doc_id"])
    return rows.select("doc_id", "p_quality", "p_toxic", "kept")


def op10_language(spark, sf_dir):
    """Trained on the labels of the documents; the label is also what each document declares."""
    docs = table(spark, sf_dir, "documents")
    rows = language.identify(docs, language.train(docs), declared_col="lang", host_col="source", keep=["doc_id", "lang"])
    won, posterior, accepted = rows.columns[-3:]  # other names where the table has these
    return rows.select("doc_id", "lang", F.col(won).alias("language"), F.col(posterior).alias("posterior"),
                       F.col(accepted).alias("kept"))


def op10_language_pages(spark, sf_dir):
    """Every page by its own text, markup language, host and address suffix, under the models of the documents."""
    pages = table(spark, sf_dir, "pages")
    url, html = F.col("url"), F.col("html")
    rows = pages.select("page_id", language.text_of(html).alias("text"),
                        language.declared_in_markup(html).alias("declared"), language.host_of(url).alias("host"),
                        language.suffix_of(language.host_of(url)).alias("suffix"))
    model = language.train(table(spark, sf_dir, "documents"))
    out = language.identify(rows, model, declared_col="declared", host_col="host", suffix_col="suffix",
                            keep=["page_id", "declared", "host", "suffix"])
    return out.select("page_id", "declared", "host", "suffix", "language", "posterior", F.col("accepted").alias("kept"))


def _ascii_lower(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op11_of(docs):
    """Manifest of ``docs`` and its check against a copy whose texts are lower-cased where 5 divides the id's CRC-32."""
    rows = merkle.manifest(docs, claims={"text": _ascii_lower(F.col("text"))},
                           changed=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                       "verified")


def op11_manifest(spark, sf_dir):
    return op11_of(table(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    """Counts under the public byte-level vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path(), limit=512)


def op13_fill_middle(spark, sf_dir):
    """Each document in its fill-in-the-middle form, and the text that the form gives back, as digests."""
    rows = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored("output", "form"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_secrets, op2_lattice, op3_lines, op4_token_files, op5_packing, op6_simhash, op7_warc, op8_decontaminate,
    op9_quality, op10_language, op10_language_pages, op11_manifest,
    op12_token_counts, op13_fill_middle)}

#: DuckDB SQL over the same tables. The others have none: they train models, hash
#: with XXH64, run a tokenizer, or compare all pairs, and are tested by brute force.
ORACLES = {
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS least FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > least THEN least END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op8_decontaminate": r"""
        WITH w AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
        bw AS (
          SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
        win AS (
          SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + 9], ' ') AS gram
          FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM bw WHERE len(ws) > 0)),
        pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        sizes AS (SELECT DISTINCT n FROM win),
        occ AS (
          SELECT p.doc_id, p.i, win.n, win.item_id FROM pos p JOIN sizes s ON p.i + s.n - 1 <= len(p.ws)
          JOIN win ON win.n = s.n AND win.gram = array_to_string(p.ws[p.i:p.i + s.n - 1], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT k)::BIGINT AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
        it AS (SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items,
                      string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM occ GROUP BY doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_manifest": """
        WITH RECURSIVE
        crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
                  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
        d AS (
          SELECT *, coalesce('s' || source, 'n') AS tree,
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
                 coalesce(xor(list_reduce(list_concat([4294967295::BIGINT],
                     list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8)), 4294967295) % 5 = 0, false) AS touched
          FROM documents, crc),
        f AS (
          SELECT doc_id, source, tree,
                 coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                 coalesce(strlen(text) || ':' || text, '-') AS held,
                 coalesce(strlen(text) || ':' || CASE WHEN touched THEN lowered ELSE text END, '-') AS told
          FROM d),
        leaves AS (
          SELECT doc_id, source, tree, sha256(head || held) AS leaf, sha256(head || told) AS claim,
                 row_number() OVER () AS rid, count(*) OVER (PARTITION BY tree) AS n,
                 row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(head || held)) - 1 AS i FROM f),
        nodes AS (
          SELECT tree, 0 AS lvl, i, n, leaf AS h FROM leaves
          UNION ALL
          SELECT tree, lvl + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
          FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 16),
        subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS g, count(*) OVER () AS n
                     FROM nodes WHERE n = 1),
        tops AS (
          SELECT 0 AS lvl, g AS i, n, subroot AS h FROM subroots
          UNION ALL
          SELECT lvl + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
          FROM tops WHERE n > 1 GROUP BY lvl, i // 16),
        runs AS (SELECT tree, lvl, i // 16 AS r, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
        top_runs AS (SELECT lvl, i // 16 AS r, list(h ORDER BY i) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
        up AS (
          SELECT rid, tree, 0 AS lvl, i, '' AS proof, claim AS x FROM leaves
          UNION ALL
          SELECT rid, up.tree, up.lvl + 1, i // 16,
                 proof || array_to_string(hs[1:i % 16], '') || array_to_string(hs[i % 16 + 2:], ''),
                 sha256(array_to_string(hs[1:i % 16], '') || x || array_to_string(hs[i % 16 + 2:], ''))
          FROM up JOIN runs ON runs.tree = up.tree AND runs.lvl = up.lvl AND runs.r = up.i // 16),
        over_top AS (
          SELECT rid, 0 AS lvl, g AS i, proof, x FROM up JOIN subroots USING (tree)
          WHERE (tree, lvl) IN (SELECT (tree, lvl) FROM nodes WHERE n = 1)
          UNION ALL
          SELECT rid, over_top.lvl + 1, i // 16,
                 proof || array_to_string(hs[1:i % 16], '') || array_to_string(hs[i % 16 + 2:], ''),
                 sha256(array_to_string(hs[1:i % 16], '') || x || array_to_string(hs[i % 16 + 2:], ''))
          FROM over_top JOIN top_runs ON top_runs.lvl = over_top.lvl AND top_runs.r = over_top.i // 16)
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = t.h AS verified
        FROM over_top o JOIN leaves USING (rid) JOIN subroots USING (tree) JOIN tops t ON t.n = 1 AND t.lvl = o.lvl""",
    "op13_fill_middle": """
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                          sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
        k AS (SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
                     t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR ('0x' || x[17:24])::BIGINT % 100 >= 90 AS plain, ('0x' || x[25:32])::BIGINT % 100 < 20 AS spm FROM h),
        c AS (SELECT *, least(a, b) AS p, greatest(a, b) - least(a, b) AS m FROM k),
        o AS (SELECT *, substring(t, 1, p) AS pre, substring(t, p + 1, m) AS mid, substring(t, p + m + 1) AS suf FROM c)
        SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN p END::BIGINT AS prefix_chars, CASE WHEN NOT plain THEN m END::BIGINT AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                           ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM o""",
}
