"""Queries over the corpus operators, each applied to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, fim, html, language_model, licenses, mixing, phrases, pieces, repeats, simhash, sketches, tokenids, toxicity,
)
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_simhash(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_groups(table(spark, root, "documents"))


def op2_repeats(spark: SparkSession, root: str) -> DataFrame:
    return repeats.without_repeats(table(spark, root, "documents")).drop("kept")


def op3_token_ids(spark: SparkSession, root: str) -> DataFrame:
    return tokenids.token_digest(table(spark, root, "documents"), TOKENIZER)


def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, root, "documents"), table(spark, root, "labels"))


def op5_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return sketches.neighbour_sketches(table(spark, root, "documents"))


def op6_html(spark: SparkSession, root: str) -> DataFrame:
    return html.page_texts(table(spark, root, "pages"))


def op7_licenses(spark: SparkSession, root: str) -> DataFrame:
    return licenses.license_lines(table(spark, root, "documents"))


def op8_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op9_language_model(spark: SparkSession, root: str) -> DataFrame:
    return language_model.lm_scores(table(spark, root, "documents"))


def op10_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix_plan(table(spark, root, "documents")).drop("source", "copies")


def op11_pieces(spark: SparkSession, root: str) -> DataFrame:
    return pieces.piece_digests(table(spark, root, "documents"), PIECES)


def op12_phrases(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents"))


def op13_fill_in_middle(spark: SparkSession, root: str) -> DataFrame:
    return fim.digests(table(spark, root, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_repeats": op2_repeats,
    "op3_token_ids": op3_token_ids,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprints": op5_fingerprints,
    "op6_html": op6_html,
    "op7_licenses": op7_licenses,
    "op8_decontaminate": op8_decontaminate,
    "op9_language_model": op9_language_model,
    "op10_mixing": op10_mixing,
    "op11_pieces": op11_pieces,
    "op12_phrases": op12_phrases,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op8_decontaminate": f"""
        with items as (select distinct item_id, text from benchmark where text is not null),
        item_words as (select item_id, text, {_WORDS} as w from items),
        item_shingles as (
            select distinct item_id, text, least(5, len(w)) as n,
                array_to_string(w[i : i + least(5, len(w)) - 1], ' ') as s
            from item_words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0
        ),
        lengths as (select distinct n from item_shingles),
        sizes as (select item_id, text, n, count(*) as n_shingles from item_shingles group by all),
        docs as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
        doc_shingles as (
            select distinct r, doc_id, n, array_to_string(w[i : i + n - 1], ' ') as s
            from docs, lengths, unnest(range(1, len(w) - n + 2)) as t(i)
        ),
        shared as (
            select r, doc_id, item_id, text, n, count(*) as n_shared
            from doc_shingles join item_shingles using (n, s) group by all
        )
        select doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles as containment
        from shared join sizes using (item_id, text, n) where n_shared >= ceil(0.8 * n_shingles - 1e-9)
    """,
    "op10_mixing": r"""
        with sized as (
            select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
                md5(coalesce(doc_id::varchar, '')) || md5(coalesce(text, '')) as tie
            from documents
        ),
        sources as (
            select source, sum(size)::bigint as source_size,
                [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
            from sized group by source
        ),
        caps as (select *, source_size * 2.0::double as cap, source_size * 2.0::double / weight as filled from sources),
        levels as (
            select *, sum(source_size) over () * 1.5::double as everything,
                sum(cap) over (order by filled, source nulls last rows unbounded preceding)
                    + filled * (sum(weight) over () - sum(weight) over (order by filled, source nulls last rows unbounded preceding)) as needed
            from caps
        ),
        shares as (
            select *, coalesce(sum(case when needed <= everything then cap end) over (), 0.0) as spent,
                sum(case when needed <= everything then null else weight end) over () as open
            from levels
        ),
        targets as (
            select source, source_size,
                case when needed <= everything then cap else least(weight * (everything - spent) / open, cap) end as target,
                ('0x' || substr(md5('0:' || coalesce(source, '<null>')), 1, 8))::bigint / 4294967296.0::double as u
            from shares
        ),
        placed as (select *, row_number() over (partition by source order by size, tie) as place from sized),
        rated as (
            select p.*, t.source_size, t.target, t.u, case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate
            from placed p join targets t on p.source is not distinct from t.source
        )
        select doc_id, size::bigint as size, source_size, target,
            ((floor(place * rate + u) - floor((place - 1) * rate + u)) * size)::bigint as taken
        from rated
    """,
    "op12_phrases": r"""
        with lowered as (
            select coalesce(lang, 'und') as lang,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        ),
        pieces as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
            from (select lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) as piece from lowered)
        ),
        grams as (
            select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*) as f
            from pieces, (values (1), (2), (3)) as sizes(k), unnest(range(1, len(w) - k + 2)) as t(i) group by all
        ),
        totals as (select lang, sum(f)::bigint as n from grams where k = 1 group by lang),
        often as (select *, string_split(phrase, ' ') as w from grams where f >= 10),
        cuts as (
            select lang, phrase, f as a, c, array_to_string(w[1 : c], ' ') as head, array_to_string(w[c + 1 :], ' ') as tail
            from often, unnest(range(1, k)) as t(c) where k > 1
        ),
        scored as (
            select lang, cuts.phrase as phrase, a, c, h.f as l, t.f as r, (a::hugeint * a * 1000000) // (h.f::hugeint * t.f) as score
            from cuts join often h using (lang) join often t using (lang) where h.phrase = head and t.phrase = tail
        ),
        lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
        around as (
            select lang, array_to_string(w[i : i + 1], ' ') as phrase, max(f) as f
            from often, unnest(range(1, 3)) as t(i) where k = 3 group by all
        ),
        kept as (
            select lowest.* from lowest left join around using (lang, phrase) where around.f is null or 100 * around.f < 50 * a
        )
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a::bigint as a,
            l::bigint as l, r::bigint as r, n, score::bigint as score
        from kept join totals using (lang) qualify rank <= 2000
    """,
    "op13_fill_in_middle": """
        with hashed as (
            select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h,
                regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u
            from documents
        ),
        drawn as (
            select *, len(u) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
                ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
            from hashed
        ),
        cut as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as x, greatest(h1 % (n + 1), h2 % (n + 1)) as y,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
                    then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
            from drawn
        ),
        parts as (
            select *, coalesce(array_to_string(u[1 : x], ''), '') as p, coalesce(array_to_string(u[x + 1 : y], ''), '') as m,
                coalesce(array_to_string(u[y + 1 :], ''), '') as s
            from cut
        )
        select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
            case when form <> 'plain' then length(m) end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
            sha256(text) as restored_sha256
        from parts
    """,
}
