"""DuckDB SQL for the queries that SQL can state."""

HARD_NEGATIVES = """
    with used as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v,
               case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select a.vec_id as anchor_id, b.vec_id, a.label = b.label as alike,
               list_inner_product(a.v, b.v)::bigint as score
        from used a join used b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
        where a.vec_id % 100 = 0),
    positives as (
        select anchor_id, vec_id as positive_id, score as positive_score
        from scored where alike
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, cast(row_number() over places as integer) as rank,
           vec_id as negative_id, positive_score, score as negative_score
    from positives join scored using (anchor_id)
    where not alike and 80 * positive_score <= 100 * score and score <= positive_score
    window places as (partition by anchor_id, positive_id order by score desc, vec_id)
    qualify row_number() over places <= 5"""

_WORDS = """unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"""

#: The checksum is spelt out: a table of 256 steps from its polynomial, folded over a word's bytes.
RESAMPLING = f"""
    with steps as (
        select list_transform(range(256), lambda i: list_reduce(
            [i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as step),
    found as (select row_number() over () as place, doc_id, {_WORDS} as word from documents),
    sought as (select {_WORDS} as word from benchmark),
    spelt as (
        select word, list_transform(range(len(hex(encode(word))) // 2),
            lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint) as bytes
        from (select word from found union select word from sought)),
    placed as (
        select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, bytes),
            lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) % 10000 as bucket
        from spelt, steps),
    raw as (select bucket, count(*) as s from found join placed using (word) group by bucket),
    target as (select bucket, count(*) as t from sought join placed using (word) group by bucket),
    sums as (select (select count(*) from found)::double as all_s,
                    (select count(*) from sought)::double as all_t),
    gains as (
        select bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (all_s + 10000)
                   / ((s + 1.0::double) * (all_t + 10000))))::bigint as gain
        from raw left join target using (bucket), sums),
    weights as (
        select doc_id, count(*) as n_features, sum(gain)::bigint as weight
        from found join placed using (word) join gains using (bucket) group by doc_id),
    scored as (
        select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln(
                   (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double)
                   / 4294967296)))::bigint as score
        from documents left join weights using (doc_id)),
    able as (
        select doc_id, row_number() over (order by score desc, doc_id) as place,
               count(*) over () as n
        from scored where n_features >= 20)
    select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
    from scored left join able using (doc_id)"""
