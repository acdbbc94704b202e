"""Fixed values of the data model, and the few parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Severity of consequence terms (lower is more severe), lists of terms, imputation constants, variant types.
SEVERITY = {
    "transcript_ablation": 1, "splice_acceptor_variant": 2, "splice_donor_variant": 3, "stop_gained": 4, "frameshift_variant": 5,
    "stop_lost": 6, "start_lost": 7, "transcript_amplification": 8, "feature_elongation": 9, "feature_truncation": 10,
    "inframe_insertion": 11, "inframe_deletion": 12, "missense_variant": 13, "protein_altering_variant": 14,
    "splice_donor_5th_base_variant": 15, "splice_region_variant": 16, "splice_donor_region_variant": 17,
    "splice_polypyrimidine_tract_variant": 18, "incomplete_terminal_codon_variant": 19, "start_retained_variant": 20,
    "stop_retained_variant": 21, "synonymous_variant": 22, "coding_sequence_variant": 23, "mature_miRNA_variant": 24,
    "5_prime_UTR_variant": 25, "3_prime_UTR_variant": 26, "non_coding_transcript_exon_variant": 27, "intron_variant": 28,
    "NMD_transcript_variant": 29, "non_coding_transcript_variant": 30, "coding_transcript_variant": 31,
    "upstream_gene_variant": 32, "downstream_gene_variant": 33, "TFBS_ablation": 34, "TFBS_amplification": 35,
    "TF_binding_site_variant": 36, "regulatory_region_ablation": 37, "regulatory_region_amplification": 38,
    "regulatory_region_variant": 39, "intergenic_variant": 40, "sequence_variant": 41, "unknown": 42,
}
CODING = ("coding_sequence_variant", "frameshift_variant", "incomplete_terminal_codon_variant", "inframe_deletion", "inframe_insertion",
          "missense_variant", "protein_altering_variant", "start_lost", "stop_gained", "stop_lost")
SPLICE = ("splice_acceptor_variant", "splice_donor_5th_base_variant", "splice_donor_region_variant", "splice_donor_variant",
          "splice_polypyrimidine_tract_variant", "splice_region_variant")
SYNONYMOUS = ("start_retained_variant", "stop_retained_variant", "synonymous_variant")
FEATURES = ("SIFT", "PolyPhen", "CADD_PHRED", "REVEL", "MAX_AF", "EIGEN_PHRED", "CONDEL", "FATHMM_XF", "MutationAssessor", "phastCons_mammal",
            "phastCons_primate", "phastCons_vertebrate", "phyloP_mammal", "phyloP_primate", "phyloP_vertebrate", "oe_lof", "homAF", "CAPICE",
            "ALPHA_MISSENSE_SCORE", "HIGH_IMPACT", "IS_INDEL")
POPULATIONS = ("gnomADg_AFR_AF", "gnomADg_AMR_AF", "gnomADg_EAS_AF", "gnomADg_NFE_AF", "gnomADg_SAS_AF")
MEAN = {
    "phastCons_mammal": 0.09691308336428194, "phastCons_primate": 0.12353343703613741, "phastCons_vertebrate": 0.1366339183101041,
    "phyloP_mammal": -0.0063575303590607925, "phyloP_primate": -0.012076641890840553, "phyloP_vertebrate": 0.06761867323083483,
}
MEDIAN = {
    "ALPHA_MISSENSE_SCORE": 0.2509, "CADD_PHRED": 3.99, "CAPICE": 0.0006, "CONDEL": 0.4805749233199981, "EIGEN_PHRED": 3.010301,
    "FATHMM_XF": 0.209614, "MutationAssessor": 1.87, "oe_lof": 0.48225, "oe_mis": 0.87952, "oe_syn": 1.004, "PolyPhen": 0.547,
    "REVEL": 0.193, "SIFT": 0.153,
}
VARIANT_TYPE = {
    "splice_acceptor_variant": "loss of function variant", "splice_donor_variant": "loss of function variant",
    "frameshift_variant": "loss of function variant", "stop_gained": "loss of function variant", "stop_lost": "loss of function variant",
    "start_lost": "loss of function variant", "inframe_insertion": "inframe insertion/deletion",
    "inframe_deletion": "inframe insertion/deletion", "missense_variant": "missense variant",
    "splice_donor_5th_base_variant": "splice region variant", "splice_region_variant": "splice region variant",
    "splice_donor_region_variant": "splice region variant", "splice_polypyrimidine_tract_variant": "splice region variant",
}
CLINVAR = {"benign": 0.0, "likely_benign": 0.25, "uncertain_significance": 0.5, "likely_pathogenic": 0.75, "pathogenic": 1.0}
HGMD = {"DM": 1.0, "DM?": 0.75}
# The sentences of the question to a language model, in their order; models were asked in these words.
PROMPT = {
    "patient": "rare disease patient", "symptoms": " has the following symptoms: ",
    "question": ". A causal variant in which of the following candidate genes would best explain these symptoms? ",
    "type": "For each candidate gene the type of the variant is given in brackets. ",
    "genotype": "Furthermore the genotype of the variant is included in the brackets if it is a homozygous variant. ", "genes": "Candidate genes: ",
}
MISSING = ("", ".", "nan", "NA")
SEED = 14038


@dataclass(frozen=True)
class Settings:
    """Thresholds and weights of a run."""

    rare_af: float = 0.02
    max_af: float = 0.01
    filter_score: float = 0.7
    weights: tuple[float, float, float] = (0.34, 0.65, 0.01)  # pathogenicity, phenotype, phenotype of partner genes
    database_share: float = 0.2
    min_confidence: int = 900
    top_rank: int = 25
    prompt_rank: int = 10
    feature_columns: tuple[str, ...] = field(default=FEATURES)
