"""The operators' queries, by name, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op3_bpe
from .kmtree import op7_kmeans_tree
from .langid import op4_language_id
from .linededup import op6_line_dedup
from .lm import op2_lm_score
from .minhash import op8_minhash
from .packing import op5_packing
from .pii import op9_pii
from .pivots import op1_pivot_index
from .toxicity import op10_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pivot_index": op1_pivot_index,
        "op2_lm_score": op2_lm_score,
        "op3_bpe": op3_bpe,
        "op4_language_id": op4_language_id,
        "op5_packing": op5_packing,
        "op6_line_dedup": op6_line_dedup,
        "op7_kmeans_tree": op7_kmeans_tree,
        "op8_minhash": op8_minhash,
        "op9_pii": op9_pii,
        "op10_toxicity": op10_toxicity,
    }


#: Components: all that can be reached over links l(x, y) from each node.
_REACH = """e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT id AS a, id AS b FROM ids UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
k AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)"""

_NEAR_VECTORS = f"""WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
{_REACH}, n AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept FROM ids JOIN k ON k.a = id LEFT JOIN n ON n.x = id"""

_NEAR_DOCUMENTS = f"""WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, CASE WHEN len(w) >= 5 THEN len(w) - 3 WHEN len(w) > 0 THEN 2 ELSE 1 END)) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
{_REACH}
SELECT id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, id = component_id AS kept FROM ids JOIN k ON k.a = id LEFT JOIN n ON n.doc_id = id"""


def oracle_sql() -> dict[str, str]:
    """The other operators need a tokenizer, a model, offsets or an approximate index, or are
    too slow in SQL on whole tables; they are tested against brute force."""
    return {"op1_pivot_index": _NEAR_VECTORS, "op8_minhash": _NEAR_DOCUMENTS}
