"""Row layouts of the library's tables, as DDL strings."""

ORD = "struct<file_idx:int,file:string,block:bigint,seq:bigint>"

FASTA_RECORDS = (
    f"species string, file string, ord {ORD}, header string, accession string, "
    "sequence string, length int"
)
FILTER_STATS = (
    "species string, total_records bigint, unique_genes bigint, unidentified bigint, "
    "output_records bigint, detected_format string"
)
GENE_COUNTS = "family_id string, species string, copies bigint"
TREE_EDGES = (
    "tree_id string, node_id bigint, parent_id bigint, label string, "
    "branch_length double, is_tip boolean, child_ord int"
)
CALIBRATIONS = (
    "name string, sp1 string, sp2 string, age double, min_age double, "
    "max_age double, error string"
)
REPORT = "severity string, code string, subject string, detail string"
