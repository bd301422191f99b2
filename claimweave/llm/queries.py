"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from claimweave.llm.collocations import OP12_SQL, op12_phrases
from claimweave.llm.fingerprints import op1_fingerprints
from claimweave.llm.jaccard_join import op2_jaccard_join
from claimweave.llm.lexical_search import OP13_SQL, op13_ranked_search
from claimweave.llm.mixing import op9_mixing
from claimweave.llm.near_vectors import op11_near_vectors
from claimweave.llm.packing import op8_packing
from claimweave.llm.personal_data import op3_personal_data
from claimweave.llm.pivot_search import OP5_SQL, op5_pivot_search
from claimweave.llm.quality import op4_quality
from claimweave.llm.repeats import op10_repeats
from claimweave.llm.sharding import op6_sharding
from claimweave.llm.token_files import op7_token_files

QUERIES = {
    q.__name__: q
    for q in (
        op1_fingerprints, op2_jaccard_join, op3_personal_data, op4_quality, op5_pivot_search, op6_sharding,
        op7_token_files, op8_packing, op9_mixing, op10_repeats, op11_near_vectors, op12_phrases, op13_ranked_search,
    )
}
ORACLES: dict[str, str] = {"op5_pivot_search": OP5_SQL, "op12_phrases": OP12_SQL, "op13_ranked_search": OP13_SQL}
