"""Fixed values of the survey domain."""

#: Question type to processing branch; anything else goes to ETC, a missing type ends the question.
BRANCHES = {"concept": "WORD", "img": "WORD", "depend": "SENTENCE", "depend_pos_neg": "SENTENCE", "pos_neg": "SENTENCE", "etc": "ETC"}
OTHER_BRANCH, NO_BRANCH = "ETC", "__END__"
#: Question types in the order in which they win.
TYPE_ORDER = ["etc_pos_neg", "depend_pos_neg", "etc", "depend", "img", "pos_neg", "concept"]
KEY_COLUMNS = ["IDKEY", "ID", "UID", "id_key", "idkey", "key", "번호", "식별자"]
HEADER_OFFSETS = range(6)
NOT_ANSWERS = ["START_TIME", "END_TIME", "DATA_TIME", "ACCESS_KEY", "USER_AGENT", "USER_DEVICE", "IS_MOBILE", "IP", "RESULT", "LAST_QUESTION", "LAST_BEFORE_QUESTION", "면접원"]
STRING_RATIO = 0.8
OPEN_SKIP_ROWS = 5
#: What spreadsheet readers take for no value, and fillers to be ignored in answers.
NULL_TOKENS = ["", "NA", "NaN", "nan", "None", "NULL", "null", "N/A", "#N/A", "<NA>"]
FILLERS = ["merged", "nan", "NaN", "None", "NULL", "Name: 0, dtype: object"]
MAX_ATOMIC = 3
NEIGHBOURS, INFLATION, MCL_ITERATIONS, CSLS_CUT, MIN_SAMPLES = 15, 2.0, 100, 0.1, 5
MAX_K, MIN_CLUSTER_SHARE = 7, 0.03
DBSCAN_PERCENTILES, DBSCAN_MIN_SAMPLES = [0.15, 0.25, 0.35, 0.45], [3, 5, 7]
NMI_WEIGHT, ARI_WEIGHT = 0.6, 0.4
GRADES = [(0.96, "EXCELLENT"), (0.88, "GOOD"), (0.83, "FAIR"), (0.72, "IMPROVE")]
LAST_GRADE = "FAIL"
COARSE_GRADES = [(0.8, "A"), (0.6, "B"), (0.4, "C"), (0.2, "D")]
LAST_COARSE_GRADE = "F"
VECTOR_SIZE = 384
