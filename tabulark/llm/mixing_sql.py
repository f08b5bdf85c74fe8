"""DuckDB SQL of the mix: every seat is enumerated and ranked."""


def mix_sql(seed: int = 1, block: int = 16) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS mark
  FROM documents),
p AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY source ORDER BY mark, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
  FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no, (3 * source_size)::BIGINT AS cap,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM s0),
s2 AS (SELECT *, (CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight FROM s1),
s3 AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
            / (sum(weight) OVER (ORDER BY cap / weight, no
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM s2),
s4 AS (
  SELECT *, cap < weight * level AS capped FROM s3),
s5 AS (
  SELECT *, CASE WHEN capped THEN cap::DOUBLE ELSE weight * (
      (total - (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT)
      / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::BIGINT) END AS target,
    round(total / {block})::BIGINT AS seats
  FROM s4),
bids AS (
  SELECT no, seats, target / (2 * k - 1) AS quotient
  FROM s5, range(1, (target / {block})::BIGINT + 25) AS r(k) WHERE target > 0),
won AS (
  SELECT no, count(*)::BIGINT AS blocks
  FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, no) AS place FROM bids)
  WHERE place <= seats GROUP BY no),
g AS (
  SELECT *, least(blocks * {block}, cap) AS want FROM s5 LEFT JOIN won USING (no)),
h AS (
  SELECT *, coalesce(floor(want / nullif(source_size, 0)), 0)::BIGINT AS passes FROM g),
i AS (
  SELECT *, (round((want - passes * source_size) / {block}) * {block})::BIGINT AS more FROM h)
SELECT p.doc_id, p.source, p.size, i.source_size, i.target, i.passes,
       greatest(0, least(p.size, CASE WHEN passes < 3 THEN more - before ELSE 0 END))::BIGINT AS part,
       (passes * p.size
        + greatest(0, least(p.size, CASE WHEN passes < 3 THEN more - before ELSE 0 END)))::BIGINT AS taken
FROM p JOIN i ON p.source IS NOT DISTINCT FROM i.source"""
