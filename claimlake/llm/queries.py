"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from . import chat_format, collocations, decontaminate, fingerprints, jaccard_join, language_id, licenses, line_dedup, near_dedup, packing, pii, ranked_search, token_files

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_language_id": language_id.op2_language_id,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_token_files": token_files.op4_token_files,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_pii": pii.op7_pii,
    "op8_pack": packing.op8_pack,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_collocations": collocations.op12_collocations,
    "op13_jaccard_join": jaccard_join.op13_jaccard_join,
}

#: Components of documents whose sets of shingles of {k} words have a Jaccard similarity of {percent} % or more.
COMPONENTS_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {k} - 1], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k} + 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node)
SELECT n.doc_id, n.n AS n_shingles, min(root) AS component_id{more} FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""

ORACLES = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op3_license_scan": licenses.OP3_SQL,
    "op5_chat_format": chat_format.OP5_SQL,
    "op10_near_dedup": COMPONENTS_SQL.format(k=5, percent=75, more=", min(root) = n.doc_id AS kept"),
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_jaccard_join": COMPONENTS_SQL.format(k=4, percent=85, more=""),
}
