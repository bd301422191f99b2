"""Word lists whose contents decide results.

Each list below is data, in natural order. Two stopword sets and two fact-check
lists exist because retrieval and reranking use different ones.
"""

# --- fixed values: retrieval ---------------------------------------------------------
RETRIEVAL_STOPWORDS = (
    "the and for that this with from into after before during said says was were has have had "
    "will would could should about their there they them india indian according report reports "
    "claim claims news "
    "और यह इस उस एक के की का में से पर को ने है था थे हो रहा रही रहे कहा बताया"
).split()

GENERIC_EVENT_WORDS = (
    "state states country people government according report reports news said says claim claims "
    "india indian pakistani american former current new latest"
).split()

BROAD_ENTITIES = "india indian people government country भारत भारतीय लोग सरकार".split()

RETRIEVAL_FACT_CHECK_TERMS = [
    "fact check", "fact-check", "factcheck", "फैक्ट चेक", "फैक्ट-चेक", "सच", "झूठ", "वायरल",
    "पड़ताल", "तथ्य जांच", "अल्ट न्यूज़", "alt news", "boom", "boomlive", "vishvas news",
]

# --- fixed values: reranking ---------------------------------------------------------
RERANK_STOPWORDS = (
    "the and for that this with from into after before during said says was were has have had "
    "will would could should about their there they them india indian according report reports "
    "claim claims news "
    "और यह इस उस एक के की का में से पर को भी है हैं था थी थे हुए हुआ हुई ने हो गया गई"
).split()

RERANK_FACT_CHECK_TERMS = [
    "fact check", "fact-check", "factcheck", "fact check:", "पड़ताल", "फैक्ट चेक", "फैक्टचेक",
    "सच क्या है", "वायरल दावे का सच", "वायरल तस्वीर का सच", "दावे की सच्चाई", "झूठा दावा",
    "गलत दावा", "सच्चाई क्या है",
]

FALSE_TERMS = [
    "false", "fake", "fabricated", "misleading", "false claim", "fake news", "incorrect", "wrong",
    "गलत", "झूठा", "झूठी", "फर्जी", "भ्रामक", "नकली",
]

TRUE_TERMS = ["true", "correct", "verified", "accurate", "सही", "सच", "सत्य", "पुष्टि"]

# --- fixed values: verdicts ----------------------------------------------------------
VERDICTS = ["FAKE", "REAL", "UNCERTAIN"]
RELATIONS = ["supports", "contradicts", "unrelated", "insufficient"]
EVIDENCE_TYPES = ["FACT_CHECK", "FACT_CHECK_FALSE", "FACT_CHECK_TRUE", "NEWS"]
