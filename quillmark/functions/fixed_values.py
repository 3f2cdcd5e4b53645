"""FIXED VALUES.

Texts, word lists and constants that have to be exactly these for prompts, labels
and filters to mean what existing datasets and models expect. Stated plainly; no logic here.
"""

# --- labels -----------------------------------------------------------------
LABEL_NAMES = {0: "negative", 1: "neutral", 2: "positive"}
LABEL_CODES = {"negative": 0, "neutral": 1, "positive": 2}
DEFAULT_LABEL_CODE = 1

# --- corpus -----------------------------------------------------------------
CATEGORY_PREFIX = "Category:"
BLOCKED_SUMMARY_WORDS = ("Biden", "Trump")
TITLE_SEPARATOR = " : "
CHUNK_SIZE = 1022
CHUNK_OVERLAP = 64

# --- conversations ----------------------------------------------------------
STOP_PHRASES = ("not specified", "not mentioned", "unknown", "no information provided")
DEFAULT_SYSTEM_TEXT = "You are a helpful assistant."
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"

# --- curation and scoring ---------------------------------------------------
PAIRS_PER_CHUNK = 25
RATING_BATCH = 4
RATING_THRESHOLD = 5.0
SIMILARITY_THRESHOLD = 0.5
EVAL_SHARE = 0.1
MISSING_REASONING_SCORE = 1

# --- prompts ----------------------------------------------------------------
ANSWER_INSTRUCTION = "\nBriefly, just give the straight answer to the question."

JUDGE_SYSTEM_TEXT = (
    "You are an impartial evaluator. You must respond with a single word: Yes or No."
)

JUDGE_TEMPLATE = """You are an impartial evaluator.
Your task is to determine if the "Generated Answer", even if too verbose, correctly answers the "Question".
The "Expected Answer" is provided as a reference for the correct information.

Question:
{question}

Expected Answer:
{expected}

Generated Answer:
{generated}

Is the "Generated Answer" correct? Please answer with "Yes" or "No".
"""

EXPLAIN_SYSTEM_TEXT = (
    "You are a senior financial analyst with deep expertise in equity markets, corporate finance, and macroeconomics. "
    "Your task is to explain, in 2-4 sentences, why a financial news headline carries a specific market sentiment. "
    "Focus strictly on the financial implications: how the news affects revenue, profitability, cash flow, investor confidence, or market positioning. "
    "Be concise and precise. Do not repeat the sentence verbatim."
)

EXPLAIN_TEMPLATE = """Financial news headline:
"{sentence}"

This headline has been classified as **{sentiment}** sentiment from a financial markets perspective.

Explain why, focusing on the financial implications for investors, the company, or the broader market."""

CLASSIFY_INSTRUCTION = """You are a financial analyst with expertise in equity markets and corporate finance.
Analyze the following financial news headline and determine its market sentiment from an investor's perspective.

Classify the sentiment as positive, neutral, or negative based on the likely impact on stock price, investor confidence, or financial performance.

Respond using exactly these two tags:
<sentiment>positive|neutral|negative</sentiment>
<reasoning>brief financial explanation</reasoning>
"""

HEADLINE_TEMPLATE = '\nHeadline: "{text}"\n'
HEADLINE_MARK = "\nHeadline: "

TAGGED_ANSWER_TEMPLATE = "<sentiment>{sentiment}</sentiment>\n<reasoning>{reasoning}</reasoning>"

REASONING_JUDGE_TEMPLATE = """You are a master financial analyst judging the quality of reasoning for a sentiment classification.

Headline: "{sentence}"
Classified Sentiment: {sentiment}
Provided Reasoning: "{reasoning}"

Score the reasoning 1-10 across financial accuracy, depth of insight, and clarity:
  1-2  Wrong, irrelevant, or missing.
  3-4  Partially correct but shallow or off-topic.
  5-6  Accurate but generic; no link to price, confidence, or performance.
  7-8  Solid and relevant; connects the headline to a financial outcome.
  9-10 Precise, insightful, and concise; clearly justifies the sentiment.

Respond with a single number from 1 to 10. Do not provide any other text."""

SUMMARY_TEMPLATE = "Summarize this document in 3-5 sentences, focusing on the main topic and key concepts.\n"

QA_TEMPLATE = """Create 25 question-answer pairs from this text for LLM training.

Rules:
1. Questions must be about important facts in the text
2. Always use full names in questions, never use pronouns
3. Answers must be directly supported by the text
4. Output ONLY a valid JSON format, no explanations, no markdown:

[
  {
    "question": "Question 1?",
    "answer": "Answer 1."
  },
  {
    "question": "Question 2?",
    "answer": "Answer 2."
  }
]

Text:
{text}
"""

RATING_TEMPLATE = """Rate each of these question-answer pairs for quality and return exactly this JSON format:

[
  {"question": "same question text", "answer": "same answer text", "rating": n}
]

Where n is a number from 1-10, using this scale:
1=wrong/nonsensical 
3=vague/incomplete 
5=correct but generic 
7=accurate and useful 
9=insightful and precise 
10=perfect

DO NOT include any text outside of the JSON array, just return valid JSON:

{pairs}
"""
