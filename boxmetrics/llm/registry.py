"""The queries of this subpackage, by name."""

from .decontam import op2_decontaminate
from .gif import op1_gif_media
from .hmm import op3_hmm_score
from .license import op9_license_scan
from .mixing import op7_temperature_mix
from .pii import op5_pii_weak
from .quality import op6_quality_pu
from .ranked import OP12_SQL, op12_block_max
from .repair import OP11_SQL, op11_repair_layers
from .rules import OP13_SQL, op13_quality_quantiles
from .simhash import op10_simhash_covering
from .substring import OP8_SQL, op8_substring_countmin
from .toxicity import op4_toxicity_zstd

QUERIES = {
    "op1_gif_media": op1_gif_media,
    "op2_decontaminate": op2_decontaminate,
    "op3_hmm_score": op3_hmm_score,
    "op4_toxicity_zstd": op4_toxicity_zstd,
    "op5_pii_weak": op5_pii_weak,
    "op6_quality_pu": op6_quality_pu,
    "op7_temperature_mix": op7_temperature_mix,
    "op8_substring_countmin": op8_substring_countmin,
    "op9_license_scan": op9_license_scan,
    "op10_simhash_covering": op10_simhash_covering,
    "op11_repair_layers": op11_repair_layers,
    "op12_block_max": op12_block_max,
    "op13_quality_quantiles": op13_quality_quantiles,
}
ORACLE = {
    "op8_substring_countmin": OP8_SQL,
    "op11_repair_layers": OP11_SQL,
    "op12_block_max": OP12_SQL,
    "op13_quality_quantiles": OP13_SQL,
}
