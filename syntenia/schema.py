"""Schemas of the tables that the operators exchange."""

from __future__ import annotations

#: The nine columns of a feature file.
GFF = "seqid string, source string, type string, start long, end long, score string, strand string, phase long, attributes string"
#: A parsed feature table: stable row order and the resolved hierarchy.
FEATURES = f"row_idx long, {GFF}, ID string, ParentID string, mRNA string, gene string"
#: Tabular alignments; ``positive`` is a fourteenth column that some files have.
HSP = (
    "prot_id string, chr_id string, prot_len long, length long, prot_start long, prot_end long, loc_start long, loc_end long, "
    "nident long, pident double, gapopen long, evalue double, bitscore double"
)
HSP_POSITIVE = f"{HSP}, positive long"
#: The aligner's standard twelve columns.
BLAST12 = "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
#: Eight-column protein alignments.
BLAST8 = "qstart long, qend long, sstart long, send long, bitscore double, positive long, nident long, length long"
INTERVALS = "array<struct<start:bigint,end:bigint>>"
#: What chaining finds in an island, before scores.
CHAINS = (
    "chr_id string, strand int, prot_id string, prot_len long, island long, chain int, "
    f"chr_path {INTERVALS}, prot_path {INTERVALS}, chr_start long, chr_end long, prot_start long, prot_end long, "
    "nident long, nhomol_loc long, nhomol_prot long"
)
FASTA = "seqid string, description string, seq string, len long"
LOCUS_INFO = "gene_id string, family string, class string"
PAIRS = "target string, query string, strand string"
ALERT = "chr string, prot_id string, no_start boolean, no_stop boolean, fs boolean, splice boolean, stop_in_frame boolean, length_pb boolean, validity string"
