"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import (
    byte_bpe,
    chunk_dedup,
    code_search,
    collocations,
    exact_dedup,
    line_dedup,
    merkle,
    mixing,
    ngram_lm,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)
from sensorlake.llm.common import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources at equal shares of characters, in the volume there is."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"), training=fold(5) != 0)
    rows = docs.select("doc_id", "text", (fold(5) == 0).alias("held_out"))
    return scorer.score(rows, "text").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op6_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 100, against all vectors."""
    codes = materialize(
        code_search.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "codes-all"
    )
    bits = codes.agg(F.max(F.size("code"))).first()[0] or 1
    return code_search.nearest(codes, codes.where("id % 100 = 0"), bits=64 * bits, k=10)


def fold(modulus: int) -> Column:
    """The remainder of the CRC-32 of an id's text; a row without an id has that of no text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), training=fold(7) != 2)


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = chunk_dedup.without_repeats(table(spark, sf_dir, "documents"), lone_tails=False)
    return left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def tokenizer(spark: SparkSession) -> byte_bpe.ByteBpe:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.ByteBpe(spark, path, public_tokenizers.PATTERN)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(docs, tokenizer(spark))


def token_digests(docs: DataFrame, bpe: byte_bpe.ByteBpe, *others: str) -> DataFrame:
    """Digests of the ids of each text and of the bytes they decode to; also ``others``."""
    kept = {"doc_id", "text", *others} - {"ids"}
    coded = byte_bpe.encode_and_decode(docs.select(*kept), bpe)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *others,
    )


#: Verdict and name of the rules on sites: a host with its subdomains, and how the path begins.
SITE_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
#: Words that block an address where no rule on its site fits.
BLOCKED_WORDS = ["adult", "ads", "bets", "casino", "pills", "porn", "spam", "viagra"]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(name, f"||{name}", verdict, 0) for verdict, name in SITE_RULES]
    rows += [(f"^{word}^", f"^{word}^", "block", 1) for word in BLOCKED_WORDS]
    rules = spark.createDataFrame(rows, url_filter.RULES)
    site = F.col("tier") == 0
    return url_filter.judged(table(spark, sf_dir, "pages"), rules).select(
        "page_id",
        "host",
        "path",
        F.when(site, F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        F.when(~site, F.col("rule")).alias("pattern"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without an id is not tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in fields]
    forged = F.when(tampered, merkle.leaf(*changed))
    listed = merkle.manifest(docs, fields, carry={"forged": forged})
    folded = merkle.fold(F.coalesce("forged", "leaf"), F.col("witness"))
    return listed.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof(F.col("witness")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_code_search": op6_code_search,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_simhash": op9_simhash,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_url_filter": op11_url_filter,
    "op12_collocations": op12_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op1_source_mixing": """
        with sizes as (
            select source, sum(length(text)) as chars from documents
            group by source having sum(length(text)) > 0
        ),
        rated as (
            select source, (1.0::double / (select sum(1.0::double) from sizes))
                * (select sum(chars) from sizes)::double / chars::double as rate from sizes
        ),
        parted as (
            select source, cast(ceil(rate / 8) as bigint) as parts, rate / ceil(rate / 8) as mean
            from rated where rate > 0
        ),
        terms as (
            select source, parts, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) as term
            from parted, range(0, 65) as ks(k)
        ),
        chances as (
            select source, parts, k,
                sum(term) over (partition by source order by k) as chance
            from terms
        ),
        tables as (
            select source, parts, list(chance order by k) as chances from chances
            group by source, parts
        ),
        draws as (
            select d.doc_id, t.chances,
                ('0x' || substr(md5('0:' || d.doc_id || ':' || p), 1, 13))::bigint
                    / 4503599627370496.0::double as u
            from documents d join tables t on d.source is not distinct from t.source,
                unnest(range(1, t.parts + 1)) as ps(p)
        ),
        counts as (
            select doc_id, sum(len(list_filter(chances, lambda c: c <= u))) as copies
            from draws group by doc_id
        )
        select d.*, c.copy::int as copy,
            ('0x' || substr(md5('0:' || d.doc_id || ':' || c.copy || ':place'), 1, 15))::bigint
                as mix_key
        from documents d join (
            select doc_id, unnest(range(1, copies::bigint + 1)) as copy from counts
        ) c using (doc_id)
    """,
    "op3_suffix_dedup": """
        with docs as (
            select doc_id, hex(encode(coalesce(text, ''))) as h from documents
        ),
        windows as (
            select doc_id, place, substr(h, 2 * place + 1, 200) as w
            from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as place from docs)
        ),
        later as (
            select doc_id, place from windows
            qualify row_number() over (partition by w order by doc_id, place) > 1
        ),
        marked as (
            select *, coalesce(place > lag(place) over same + 100, true) as opens
            from later window same as (partition by doc_id order by place)
        ),
        numbered as (
            select *, sum(opens::int) over (partition by doc_id order by place) as span from marked
        ),
        spans as (
            select doc_id, min(place) as b, max(place) + 100 as e from numbered group by doc_id, span
        ),
        placed as (
            select *, coalesce(lag(e) over (partition by doc_id order by b), 0) as last from spans
        ),
        removed as (
            select doc_id, sum(e - b)::bigint as n_removed, count(*) as n_spans, max(e) as last,
                string_agg(substr(h, 2 * p.last + 1, 2 * (b - p.last)), '' order by b) as kept
            from placed p join docs using (doc_id) group by doc_id
        )
        select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed,
            coalesce(n_spans, 0) as n_spans,
            sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
        from docs left join removed using (doc_id)
    """,
    "op5_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
    "op6_code_search": """
        with codes as (
            select vec_id as id,
                list_transform(embedding, lambda x: (x > 0)::int) as code from embeddings
        ),
        pairs as (
            select q.id as query_id, c.id,
                list_sum(list_transform(list_zip(q.code, c.code),
                    lambda p: (p[1] <> p[2])::int))::int as distance
            from codes q, codes c where q.id % 100 = 0
        )
        select query_id, rank::int as rank, id, distance from (
            select *, row_number() over (partition by query_id order by distance, id) as rank
            from pairs
        ) where rank <= 10
    """,
    "op11_url_filter": """
        with split as (
            select page_id, strpos(coalesce(url, ''), '://') as mark, url from pages
        ),
        rests as (
            select page_id, case when mark = 0 then '' else substr(url, mark + 3) end as rest from split
        ),
        hosts as (
            select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rests
        ),
        parts as (
            select page_id, substr(rest, length(raw) + 1) as tail,
                translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
            from hosts
        ),
        pages_ as (
            select page_id, host, tail, regexp_extract(tail, '^[^?#]*') as path from parts
        ),
        rules(verdict, name, site, start) as (
            values ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
        ),
        words(word) as (
            values ('adult'), ('ads'), ('bets'), ('casino'), ('pills'), ('porn'), ('spam'), ('viagra')
        ),
        fitting as (
            select page_id, arg_max(name, length(name)) as rule, arg_max(verdict, length(name)) as v
            from pages_, rules
            where (host = site or ends_with(host, '.' || site)) and starts_with(path, start)
            group by page_id
        ),
        worded as (
            select page_id, arg_max('^' || word || '^', length(word) * 1000 - ascii(word)) as pattern
            from pages_, words
            where regexp_matches('//' || host || tail, '[^0-9A-Za-z]' || word || '([^0-9A-Za-z]|$)')
            group by page_id
        )
        select page_id, host, path, rule,
            coalesce(v, case when pattern is null then 'allow' else 'block' end) as verdict,
            case when rule is null then pattern end as pattern
        from pages_ left join fitting using (page_id) left join worded using (page_id)
    """,
    "op12_collocations": """
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) as piece
            from documents
        ),
        listed as (
            select lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') as ws
            from pieces
        ),
        totals as (
            select lang, sum(len(ws))::bigint as n from listed group by lang
        ),
        counts as (
            select lang, m, ws[i:i + m - 1] as p, count(*) as f
            from (
                select lang, ws, m, unnest(range(1, len(ws) - m + 2)) as i
                from listed, range(1, 6) as ms(m)
            ) group by lang, m, p having count(*) >= 100
        ),
        cuts as (
            select c.lang, c.m, c.p, c.f as a, l.f as l, r.f as r, n, k,
                (1000::hugeint * c.f * n) // (l.f::hugeint * r.f) as score
            from (select *, unnest(range(1, m)) as k from counts) c
            join counts l on l.lang = c.lang and l.p = c.p[1:k]
            join counts r on r.lang = c.lang and r.p = c.p[k + 1:]
            join totals t on t.lang = c.lang
        ),
        lowest as (
            select * from cuts
            qualify row_number() over (partition by lang, p order by score, k) = 1
        ),
        inside as (
            select lang, p[b:e] as p, max(f) as longer
            from (
                select lang, m, p, f, b, unnest(range(b + 1, m + 1)) as e
                from (select *, unnest(range(1, m)) as b from counts where m > 2)
            ) where e - b + 1 < m group by all
        )
        select lang, rank, phrase, a, l, r, n, score::bigint as score from (
            select w.lang, array_to_string(w.p, ' ') as phrase, a, l, r, n, score,
                row_number() over (partition by w.lang
                    order by score desc, a desc, array_to_string(w.p, ' ')) as rank
            from lowest w left join inside i on i.lang = w.lang and i.p = w.p
            where longer is null or 100 * longer < 100 * a
        ) where rank <= 2000
    """,
    "op13_merkle_manifest": """
        with recursive crc(step) as (
            select list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))
        ),
        coded as (
            select *, list_reduce(list_concat([4294967295::bigint],
                    list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])) as crc
            from documents, crc
        ),
        framed as (
            select doc_id, lang, n_chars, coalesce(xor(crc, 4294967295) % 7 = 0, false) as tampered,
                coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
                    || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-') as before,
                coalesce(strlen(text) || ':' || text, '-') as after
            from coded
        ),
        leaves as (
            select doc_id, lang, sha256(before || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || after) as leaf,
                sha256(before || coalesce(strlen((n_chars + tampered::int)::varchar) || ':' || (n_chars + tampered::int), '-') || after) as forged
            from framed
        ),
        placed as (
            select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place
            from leaves
        ),
        tree(lang, level, place, h, size) as (
            select lang, 0, place, leaf, count(*) over (partition by lang) from placed
            union all
            select lang, level + 1, place // 2, sha256(string_agg(h, '' order by place)), (max(size) + 1) // 2
            from tree where size > 1 group by lang, level, place // 2
        ),
        tops as (
            select lang, h, row_number() over (order by lang nulls first) - 1 as place,
                count(*) over () as size
            from tree where size = 1
        ),
        crown(level, place, h, size) as (
            select 0, place, h, size from tops
            union all
            select level + 1, place // 2, sha256(string_agg(h, '' order by place)), (max(size) + 1) // 2
            from crown where size > 1 group by level, place // 2
        ),
        folded(doc_id, leaf, lang, place, level, h, siblings) as (
            select doc_id, leaf, lang, place, 0, forged, '' from placed
            union all
            select f.doc_id, f.leaf, f.lang, f.place // 2, f.level + 1,
                sha256(case when f.place % 2 = 1 then s.h || f.h else f.h || coalesce(s.h, '') end),
                f.siblings || coalesce(s.h, '')
            from folded f
            join tree t on t.lang is not distinct from f.lang and t.level = f.level and t.place = f.place and t.size > 1
            left join tree s on s.lang is not distinct from f.lang and s.level = f.level
                and s.place = f.place + 1 - 2 * (f.place % 2)
        ),
        upper(doc_id, leaf, subroot, place, level, h, siblings) as (
            select f.doc_id, f.leaf, o.h, o.place, 0, f.h, f.siblings
            from folded f
            join tree t on t.lang is not distinct from f.lang and t.level = f.level and t.size = 1
            join tops o on o.lang is not distinct from f.lang
            union all
            select f.doc_id, f.leaf, f.subroot, f.place // 2, f.level + 1,
                sha256(case when f.place % 2 = 1 then s.h || f.h else f.h || coalesce(s.h, '') end),
                f.siblings || coalesce(s.h, '')
            from upper f
            join crown t on t.level = f.level and t.place = f.place and t.size > 1
            left join crown s on s.level = f.level and s.place = f.place + 1 - 2 * (f.place % 2)
        )
        select doc_id, leaf, subroot, c.h as root, sha256(siblings) as proof_sha256,
            u.h as folded_root, u.h = c.h as verified
        from upper u join crown c on c.level = u.level and c.size = 1
    """,
}
