"""Word lists and tables that define the results of rules.

They are data, in natural order, and are used by the rules of
``functions`` and ``operators`` and, through the query plans, by the SQL each
rule is held against.
"""

# Titles that begin with one of these (any case, no word boundary) are not articles.
TITLE_PREFIXES = [
    "Acknowledgments", "ADOBE PDF", "Addendum", "Advertisement", "Additional figure", "Additional Material",
    "Additional Table", "All Supplemental Data", "All Supplemental Figures",
    "All Supplemental Figures, Tables and Legends", "All Supplementary Data",
    "All Supplementary Figures", "All Supplementary Figures and Tables",
    "All Supplementary Tables, Figures and Methods", "Analysis Methods Supplement",
    "Appendix", "Article figures", "Author Correction", "Auxiliary Supplementary File",
    "Caption for Suppl Fig.", "Captions of supplementary", "Combined supplemental figures",
    "Contents Vol", "Contents:",
    "Corrigendum", "Correction", "Correction to", "Correction:", "Corrections to",
    "Data Augmentation", "Data associated with", "Data and code", "Data and analysis scripts", "Data File",
    "Data for", "Data from", "Data not shown", "Data and metadata",
    "Data on", "Data S", "Data Spreadsheet", "Data Supplement", "Data.zip",
    "Dataset", "Dataset and metadata", "Dataset for", "Dataset related to",
    "Description of Supplemental Figures", "Description of supplementary",
    "Download Supplementary", "eFigure", "Erratum", "Extended Data", "Expression of Concern",
    "Fig", "Fig.", "Fig Supp", "FigS", "Figure", "Figure S", "Figures", "Instructions for Authors",
    "File", "Funding statement", "http://", "https://",
    "Legend for", "Legend from", "Legend of", "Legend to",
    "Legends for", "Legends from", "Legends of", "Legends to",
    "Legends Supplemental Figures", "Link to Supplementary",
    "List of figures", "List of tables", "List of plates", "Manuscript Figures",
    "Mat & Met", "Material and Methods", "Materials and Methods",
    "Merged Supplementary", "Metadata and data", "Metadata record for",
    "Metadata supporting", "Methods References", "Methods and Materials from",
    "Methods and Supplementary", "Methods and Tables", "Methods file",
    "Methods from", "Methods, Figures", "Methods, Table", "MET supplementary methods",
    "methods_", "Movie", "Multimedia", "Methodology and Method", "Online supplement",
    "Online Supplementary Materials", "Online Supplementary Tables",
    "Online-only supplementary", "Online-Only Tables",
    "Original Western Blot Data", "Revised Supplementary", "S Figure", "S Table",
    "S-Figure", "S1 Legend", "S1 from", "S1.", "S1:", "S2 from", "S2.", "S2:",
    "S3 from", "S3.", "S3:", "S4 from", "S4.", "S4:", "S5 from", "S5.", "S5:",
    "S6 from", "S6.", "S6:", "S7 from", "S7.", "S7:", "S8 from", "S8.", "S8:",
    "S9 from", "S9.", "S9:", "SI Figure", "SI Methods", "SI Table",
    "SI materials", "SI tables and figures", "SFigure", "SF-", "SF1",
    "Sl Figure", "Supplement", "Supplement Material", "Supplement Table",
    "Supplemental", "Supplemental Data", "Supplemental Figure",
    "Supplemental Figures", "Supplemental Table", "Supplementary",
    "Supplementary Data", "Supplementary Figure", "Supplementary Figures",
    "Supplementary Legends", "Supplementary Methods", "Supplementary Movie",
    "Supplementary Table", "Supplementary Tables", "Supplementary Text",
    "Supplementary Video", "SupplementaryFigures", "Supplementary_Figure",
    "Supplementray Figures", "Supplementray Tables", "Supplymentary Figure",
    "Supplymentary Figures", "Supplymentary Table", "Supporting Data",
    "Supporting Document", "Supporting Figure", "Supporting Figures",
    "Supporting File", "Supporting Information", "Supporting Legend",
    "Supporting Legends", "Supporting Materials", "Supporting Methods",
    "Supporting Table", "Supporting Tables", "Supporting Text",
    "Supporting Video", "Suppl", "Suppl Figure", "Suppl Figures", "Suppl File",
    "Suppl Info", "Suppl Information", "Suppl Legends", "Suppl List of Videos, Tables and Methods",
    "Suppl Materials and Methods", "Suppl Methods", "Suppl Movie", "Suppl Table",
    "Suppl Video", "Supplimentary Figure", "Supplimentary Methods",
    "Supplimentary Tables", "Supplimentary_Figure", "Suplementary", "Supllementary Figure",
    "Suplplementary Figure Legend", "Suplpementary Table", "Supplrmentary Figures",
    "Supplrmentary Tables", "Suppltable", "Suppltext", "Supplvideo",
    "Suppl_Figure", "Suppl-Figure", "Suupplementary Tables", "Table", "Table of Content",
    "Validation Figures", "Video", "Western Blots from", "Whole Slide Image",
]

# Titles that hold one of these as whole words are not articles.
TITLE_PHRASES = [
    "Combined Supplementary Materials", "Corrigendum", "The Case Files", "Additional file", "Figure S", "Figures S", "Manuscript Figures",
    "SI tables and figures", "Supplemental Data", "Supplemental figures", "Supplemental from", "Supplemental table", "Supplemental figure",
    "Supplementary Figure", "Supplementary Figures", "Supplementary Material", "Supplementary Methods", "Supplementary Table",
    "Supplementary Tables", "Supplementary data", "Supplementary document", "Supplementary information", "SupplementaryFigures",
    "Supplementary materials and methods", "Translation for the Article", "Video Dataset", "Operative Video",
]

# Titles that stand for a missing one.
PLACEHOLDER_TITLES = [
    "Title Not Available", "No Title", "Untitled", "N/A", "[No title available]", "No title available", "No title available - PubMed",
    "Error in Text", "Errors in Box", "Error in Author Name", "Error in Author Names", "Error in Author Surnames",
    "Errors in article text", "Error in Figure Label and Caption", "Error in Presentation of Author", "Errors in Author Name",
    "Error in Table Text", "Error in Corresponding Authorship",
]

WITHDRAWN_HEADS = ["Withdrawn", "Withdrawal", "Retracted", "Retraction", "Errata", "Erratum", "Revoked", "Removed", "Correction Notice", "Corrigendum"]

# Titles that hold one of these anywhere (any case) are not research.
NON_RESEARCH = [
    "A reply to Letter to the editor", "About the Author", "An Update from the Editor-in-Chief", "Announcement:", "Announcements", "Appeal",
    "ASO Author Reflection", "AUTHOR COPY ONLY", "Associate Editor", "Author comment:", "Author profile", "Author Reflections:", "Author reply",
    "Author response", "Author response to", "Author view", "Author's reply", "Author's respond", "Editor's Reflection", "Editors Reflection",
    "Editors' Reflection", "Editor' Reflection", "Author's response", "Author's view", "Authors reply", "Authors respond", "Authors response",
    "Authors view", "Authors' Reply", "Authors' response", "Authors's response", "Book Review", "EditorinChief", "Comment", "Comment on",
    "Commentary", "Conference Summary", "Conversation with the Editor", "Correspondence", "Editorial", "Editor Profile", "Editor response for",
    "Editor change", "New Editor", "Editor-in-Chief", "Editorinchief's introduction", "Editor's evaluation", "Editor's Introduction",
    "Editor's Message", "Editor's note", "Editors Introduction", "Editors Message", "Editors Note on", "Editors Spotlight", "Editors change",
    "Editors note", "Editors' Introduction", "Editors' Message", "Editors' note", "Foreword", "From the Editor", "From the Editor-in-Chief",
    "From the Editors...", "From the Editors Desk...", "From the Editor's desk", "From the editors desk", "From the Guest Editor",
    "Guest editor", "Guest editorial", "Introducing our new Editors", "Issue Editor Foreword", "Issue Information Editorial Board",
    "Letter to editor", "Letter to the Editor", "Letter:", "Letter Of The Editor", "Letters of the editor", "Letter-to-the-editor",
    "Letters to editor", "Letters to the editor", "Meet the First Author", "Meet the author", "Meet the editor", "Message from Editor",
    "Message from the Editor", "News", "Opinion", "our author", "our editor", "Reply:", "In reply:", "Reply to:", "In reply to:",
    "Perspective", "Preface", "Proceedings", "Publisher'?s? Note", "Reply by Author", "Reply by the author", "Reply to Editorial Comment",
    "Reply to Letter to", "Reply to correspondence", "Reply to the Letter to", "Response to Editorial", "Response to a letter",
    "Response to letter", "senior editor", "Special Section", "The Author Reply", "The Authors Reply", "To the Editor",
    "Transitioning Between Editor", "Viewpoint", "Welcome to our", "Executive Editor", "Assistant Editor",
]

BLOCKED_ABSTRACTS = ["Our website uses cookies to enhance your experience.", "(Cell Reports"]

# Wrongly decoded characters and what they stood for, replaced in this order.
MOJIBAKE = [
    ("‚Äê", "—"), ("‚Äì", "-"), ("‚Äî", "–"), ("‚Äò", "'"), ("‚Äô", "'"), ("‚Ä¢", "•"), ("‚Äû", '"'), ("‚Äú", '"'), ("‚Ä¶", "…"),
    ("¬†", " "), ("√∫", "ú"), ("√©", "é"), ("√±", "ñ"), ("√≥", "ó"), ("√∂", "ö"), ("√", ""), ("‚Ä", ""), ("‚", ""),
]

# Words that qualify a disease name, removed one after the other as whole words.
CANCER_QUALIFIERS = [
    "age", "aggressive", "advance", "advanced", "alk positive", "alk+", "ampullary", "anti", "antitumor", "brca associated",
    "brca1 associated", "brca2 associated", "brca1", "brca2", "brca 1", "brca 2", "brca-mutated", "brca-positive", "braf", "brca1-mutated",
    "brca mutant", "brca1 mutant", "brca2 mutant", "brca2 altered", "brca1/2", "brca2-mutated", "brca deficient", "brca linked",
    "brca negative", "brca positive", "cell line", "cell lines", "iii", "iiii", "iiiii", "iiiv", "iiv", "chemoresistant", "circulating",
    "disease", "diseases", "cisplatin", "dna alterations", "double negative", "early stage", "germline", "human", "kras mutant", "kras",
    "hypoxic", "intercellular", "late stage", "line", "lines", "mcf", "mcf 7", "mediastinal", "membrane", "methylated", "mice", "mouse",
    "murine", "mutation", "n myc", "organoids", "pain", "parp", "patient", "patients", "platinum-sensitive", "predisposition", "sample",
    "samples", "senescent", "silenced", "somatic", "specific", "specimen", "specimens", "stage", "tissue", "tissues", "tnbc", "tumor dna",
    "tp53", "p53", "tumor specimen", "tumorigenic", "xenograft", "xenografts", "brcawt", "dna", "biopsis", "abstract", "therapy related",
    "moderate", "advance stage", "advanced stage", "chemo", "chemotherapy", "ilc",
]
CANCER_SINGULARS = [
    ("cancers", "cancer"), ("tumour", "tumor"), ("tumours", "tumor"), ("tumors", "tumor"), ("carcinomas", "carcinoma"), ("gliomas", "glioma"),
    ("adenocarcinomas", "adenocarcinoma"),
]

# Keywords of disease names and their categories; the first that matches wins.
CANCER_KEYWORDS = [
    ("skin", "skin cancer"), ("breast", "breast cancer"), ("mammary", "breast cancer"), ("mucinous", "mucinous cancer"),
    ("lung", "lung cancer"), ("bronchio", "lung cancer"), ("spindle cell", "spindle cell cancer"),
    ("acute myeloid leukemia", "acute myeloid leukemia"), ("salivary gland", "salivary gland cancer"), ("renal", "renal cancer"),
    ("prostate", "prostate cancer"), ("pancreatic", "pancreatic cancer"), ("medulloblastoma", "medulloblastoma"),
    ("lymphoblastic leukemia", "lymphoblastic leukemia"), ("myeloid", "myeloid cancer"), ("kidney", "kidney cancer"),
    ("head and neck", "head and neck cancer"), ("gastrointestinal", "gastrointestinal cancer"), ("neurofibroma", "neurofibroma"),
    ("ovarian", "ovarian cancer"), ("ovary", "ovarian cancer"), ("supratentorial ependymoma", "supratentorial ependymoma"),
    ("cervix", "cervix cancer"), ("cervical", "cervix cancer"), ("colorectal", "colon cancer"), ("colon", "colon cancer"),
    ("endometri", "endometrial cancer"), ("melano", "melanoma"), ("laryngeal", "laryngeal cancer"), ("glioma", "glioma"),
    ("bone", "bone cancer"), ("osteo", "bone cancer"), ("peritoneal", "peritoneal cancer"), ("astrocytoma", "astrocytoma"),
    ("glioblastoma", "glioma"), ("gastric", "gastric cancer"), ("mesothelioma", "mesothelioma"), ("esophag", "esophagus cancer"),
    ("thyroid", "thyroid cancer"), ("thymus", "thymus cancer"), ("uterus", "uterine cancer"), ("spinal", "spinal cancer"),
    ("hepatocellular", "liver cancer"), ("cholangio", "cholangio cancer"), ("bile duct", "biliary tract cancer"),
    ("gliosarcoma", "glioma"), ("myeloid cancer", "hematologic cancer"), ("myeloproliferative cancer", "hematologic cancer"),
    ("myelodysplastic syndrome", "hematologic cancer"), ("essential thrombocythemia", "hematologic cancer"),
    ("myelofibrosis", "hematologic cancer"), ("barrett", "esophagus cancer"), ("fraumeni", "li-fraumeni syndrome"),
    ("liposarcoma", "liposarcoma"), ("papillary", "papillary cancer"),
]

# Amino acids: three letters and one.
AMINO_ACIDS = {
    "val": "V", "gly": "G", "glu": "E", "asp": "D", "thr": "T", "met": "M", "ala": "A", "leu": "L", "ser": "S", "pro": "P", "cys": "C",
    "phe": "F", "his": "H", "lys": "K", "asn": "N", "tyr": "Y", "trp": "W", "ile": "I", "arg": "R", "gln": "Q",
}
EXON_NAMES = [("exon19del", ["19del", "del19", "ex19del", "exon19deletion"]), ("exon20ins", ["ex20ins", "ins20", "exon20insertion", "ex20insertion"])]

# Gene names in use and the symbols they stand for.
GENE_ALIASES = {
    "CASPASE": "CASP1", "CBRAF": "BRAF", "CHECK2": "CHEK2", "CKIT": "KIT", "CMET": "MET", "CMYC": "MYC", "CTNNB": "CTNNB1",
    "CYP19": "CYP19A1", "EGFR2": "ERBB2", "ER": "ESR1", "ERB": "ERBB2", "ERB2": "ERBB2", "ERBB": "ERBB2", "ERRB2": "ERBB2",
    "ERRB3": "ERBB3", "ERRB4": "ERBB4", "ESR": "ESR1", "FACND2": "FANCD2", "FCR": "FCGR3A", "FCRIIIA": "FCGR3A", "FP": "PTGFR",
    "GAL": "GAL1", "GALECTIN": "LGALS1", "GCSF": "CSF3", "GLUT3": "SLC2A3", "GNB2L1": "RACK1", "GNAS1": "GNAS", "GP130": "IL6ST",
    "GPX": "GPX1", "GQ": "GNAQ", "HER2": "ERBB2", "HER2/NEU": "ERBB2", "HER2NEU": "ERBB2", "HER3": "ERBB3", "HER4": "ERBB4",
    "TELOMERASE": "TERT", "ATM1": "ATM", "ATR1": "ATR", "BRCA2A": "BRCA2", "CDN1A": "CDKN1A", "CDN2A": "CDKN2A", "CDN2B": "CDKN2B",
    "CNNA1": "CCNA1", "CNND1": "CCND1", "COLI": "COL1A1", "EGFRVIII": "EGFR", "FLT3ITD": "FLT3", "INSR1": "INSR", "KRASG12C": "KRAS",
    "KRASG13D": "KRAS", "NRAS1": "NRAS", "PDGFR": "PDGFRA", "PI3K": "PIK3CA", "PI3KCA": "PIK3CA", "PTEN1": "PTEN", "RASA1A": "RASA1",
    "RB1CC1A": "RB1CC1", "SMAD": "SMAD4", "SRC1": "SRC", "STAT5": "STAT5A", "TERC1": "TERC", "TERT1": "TERT", "TP5": "TP53",
    "TP53A": "TP53", "TP53B": "TP53",
}
NOT_GENES = [
    "ANDROGEN", "CYP450", "CATENIN", "CSF", "14", "2Q35", "6Q25", "8Q24", "9Q31", "VARIANT", "FCR", "FCRIIIA", "GCSF", "GAL", "GALECTIN", "GQ",
    "FNACA", "FOPNL", "FP", "GM", "G11", "VITAMIN", "ISOCITRATE", "MICRORNA", "LOC146880", "LOC643714", "LOC730100", "HISTONE3",
    "CIRCHIBADH", "SURVIVIN", "LINC00951", "LINC01614", "LINC02183", "LINC02869",
]
NOT_VARIANTS = ["vus", "c.", "loss", "indel"]
NOT_IN_VARIANTS = ["mutation", "mutated", "mut", "mutant", "sensitive", "deficient", "null", "amplified", "deficiency", "deletion", "loxp", "loss", "knockdown", "flox"]
NO_GENE = ["NONE", "NO", "NOT", "UNKNOWN", ""]
REMOVED_VARIANTS = [
    "*1", "*3", "*4", "*6", "17991801hetdeltga", "186edel", "195053ctgdel", "558560agadel", "d770indelsdsvd", "del1518", "del17p", "del18",
    "del19", "del22352249", "del22362250", "del52", "del5395", "del5395bp", "del719", "del746750", "del866c", "dele709", "dele709t710insd",
    "dele746750", "dele746a750", "dele746t751", "dele746t751insv", "dele747a750", "dele748752", "dele748a752", "delex19", "dell747e749",
    "dell747p753", "dell747p753inss", "dell747s752ins", "dell747s75linss", "dell747t751", "delp704", "delpv104p", "dels752i759",
    "delt751i759inss", "delw557k558", "ex19indel", "exon15cndel", "ckras", "cbraf", "craf", "cgfr", "cegfr", "cnras", "cmet", "cmek1",
    "cher2", "cher3", "cher4", "cher", "chk2", "cpten", "cdlkb", "cher1", "cher5",
]
KEPT_VARIANTS = ["v3", "v7"]
REJECTED_VARIANT_SHAPES = [r"^[a-z]\d{2,5}$", r"^\d{2,5}[a-z]$", r"^.*wt$", r"^\d{2,5}$", r"^[a-z]{2,}$"]

# Weights of study designs: one table for matrices, one for graphs.
MATRIX_WEIGHTS = {
    "Systematic review study": 1.0, "Clinical study": 1.0, "Observational/RWE study": 0.9, "Case report study": 0.9,
    "In vivo/Animal study": 0.8, "In vitro study": 0.7, "In silico study": 0.7, "Undefined": 0.5,
}
GRAPH_WEIGHTS = {
    "Systematic review study": 1.0, "Clinical study": 1.0, "Observational/RWE study": 0.9, "Case report study": 0.9,
    "In vivo/Animal study": 0.8, "In vitro study": 0.7, "In silico study": 0.6, "Undefined": 0.1, "Other": 0.1,
}

# Patterns of model responses.
RESPONSE_PAIR = r"Variant:\s*([\w\d.*-]+),\s*Gene:\s*([\w\d]+)"
RESPONSE_PAIR_HGVS = r"Variant:\s*([\w\d.*>-]+),\s*Gene:\s*([\w\d]+)"
RESPONSE_TRIPLE = r"^(.+?)\s*\+\s*(.+?)\s*:\s*(\w+)"
RESPONSE_LABELLED = r"^(\S.+?)\s*:\s*(\w+)"

# Patterns that normalise titles and abstracts, and what replaces them, in order.
TITLE_STEPS = [
    (r"(?i)^\s*\*?\[?(?:invited|keynote|winner|regular paper|blog)\]?\*?\s*[:\-]*", ""),
    (r"[_\-]{5,}", ""),
    (r"(?i)^\s*_*Abstract_*\s*[:\-]*", ""),
    (r"^\s*[.,\-:;/=\s]+", ""),
    (r"^\[([^\]]+)\]\.?\s*$", "$1"),
]
ABSTRACT_STEPS = [
    (r"^\s*:+\s*", ""),
    (r"[_\-]{5,}", ""),
    (r"(?i)^\s*_*Abstract_*\s*[:\-]*", ""),
    (r"^\s*[.,\-:;=\s]+", ""),
    (r"\s*<[^>]+>\s*", " "),
    (r"[,.]{2,}", "."),
]

VALID_LABELS = ["Sensitive", "Resistant", "Diagnostic"]
WEAK_LABELS = ["Unknown", "Unrelated"]

EXCLUDED_TREATMENTS = [
    "chemotherapy", "tyrosine kinase inhibitor", "radiotherapy", "hormone therapy", "adjuvant chemotherapy", "immunotherapy",
    "immune checkpoint inhibitor", "mrna vaccine", "mtor inhibitor", "radiation ionizing radiotherapy", "braf inhibitor",
    "angiogenesis inhibitor", "aromatase inhibitor", "bet inhibitor", "EGFR tyrosine kinase inhibitor therapy",
    "epidermal growth factor receptor tyrosine kinase inhibitor", "hematopoietic cell transplantation",
    "hyperthermic intraperitoneal chemotherapy", "TRK inhibitor", "therapeutic tumor infiltrating lymphocytes",
]
