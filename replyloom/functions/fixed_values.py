"""Texts, patterns, ranges and labels that results depend on.

Everything here has to be spelled exactly like this for results to agree with
existing data sets, so it is kept in one place and stated as plain text.
``{name}`` marks a slot that :func:`replyloom.functions.prompts.fill_slots`
fills with a column.
"""

# --- Fixed values: rubric text shown to the judge model ---
JUDGE_RUBRIC = """### Role
You are a professional evaluator. You need to assess the quality of a model's response to math/science problems.

### Input
- Question description
- Reference answer (may include the model's reasoning process)
- Model response to be evaluated

### Scoring Criteria
Please score from the following four dimensions (total 100 points):

1. **Correctness (50 points)** - The most important dimension
   - Is the final answer correct?
   - Are the key steps correct?
   - Are the calculation results accurate?

2. **Logic (25 points)**
   - Is the reasoning process coherent?
   - Is each step of the derivation reasonable?
   - Are there any logical errors or jumps?

3. **Clarity (15 points)**
   - Is the expression clear and concise?
   - Are the steps easy to understand?
   - Is the format standardized (e.g., using LaTeX formulas)?

4. **Completeness (10 points)**
   - Does it answer all parts of the question?
   - Are any necessary steps or explanations missing?
   - Is the final answer explicit?

### Output Format
You must output the result strictly in the following JSON format (do not add any other text):

<result>
{
  "correctness": <integer from 0-50>,
  "logic": <integer from 0-25>,
  "clarity": <integer from 0-15>,
  "completeness": <integer from 0-10>,
  "total_score": <total score, integer from 0-100>,
  "brief_comment": "<brief comment, no more than 100 words>"
}
</result>

### Evaluation Task

**Question:**
{question}

**Reference Answer:**
{reference_answer}

**Model Response:**
{model_answer}

Please score strictly according to the above format.
"""

# --- Fixed values: question text when the conversation has a system message ---
QUESTION_WITH_SYSTEM = "[System Context]\n{system}\n\n[Question]\n{question}"

# --- Fixed values: rewrite instruction (the requirements are given twice) ---
REWRITE_TASK = "Rewrite the following thinking-style answer into a non-thinking CoT answer.\n"
REWRITE_REQUIREMENTS = """Requirements:
1) Preserve all reasoning steps and key calculations. Do not shorten significantly.
2) Keep the final answer and make sure it is consistent with the reasoning.
3) Use the same language as the source (English in -> English out, Chinese in -> Chinese out).
4) Output only the rewritten text. No JSON, no extra explanation.

5) Do NOT evaluate whether requirements are met. Do NOT output phrases like "The rewritten text meets requirements". Output the rewritten answer itself only.

6) Use a structured rewritten style like:
# Step 1: ...
# Step 2: ...
# Step 3: ...
Finish with the final answer/conclusion as the last step.

Length constraint: source length is about {src_len} chars (whitespace removed). Your output must be around {src_len} chars (whitespace removed).
"""
REWRITE_FIRST_CLOSING = "Do not compress into a short summary.\n\n"
REWRITE_BODY = "Question:\n{question}\n\nContent to rewrite:\n{text}\n"
REWRITE_LAST_CLOSING = (
    "Do not compress into a short summary!! As long as possible! As much as possible!\n\n"
)

# --- Fixed values: role names ---
QUESTION_ROLES = ("human", "user")
ANSWER_ROLES = ("gpt", "assistant")
PROMPT_ROLES = ("system", "human", "user")

# --- Fixed values: whitespace as Python's str.strip and re's \s see it ---
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
WHITESPACE_CLASS = r"[\p{IsWhite_Space}\x1c-\x1f]"

# --- Fixed values: think markup, in the order it is removed ---
THINK_MARKUP = (
    r"(?s)<think>.*?</think>",
    r"</?think>",
    r"(?s)<\|begin_of_thought\|>.*?<\|end_of_thought\|>",
    r"<\|/?(?:begin_of_thought|end_of_thought)\|>",
)
THINK_BLOCKS = (
    r"(?s)<think>.*?</think>",
    r"(?s)<\|begin_of_thought\|>.*?<\|end_of_thought\|>",
)

THINK_OPENINGS = ("<think>", "<|begin_of_thought|>")
THINK_CLOSINGS = ("</think>", "<|end_of_thought|>")

# --- Fixed values: where a score object is looked for (W = WHITESPACE_CLASS) ---
STRICT_TAG = r"(?s)<result>W*(\{.*?\})W*</result>"
STRICT_BARE = r'\{[^{}]*"correctness"[^{}]*"total_score"[^{}]*\}'
ROBUST_TAG = r"(?s)<result>W*(\{.*?)W*</result>"
OUTER_BRACES = r"(?s)^[^{]*+(\{.*\})"
ROBUST_CORRECTNESS = r'(?s)\{W*"correctness"W*:W*\p{Nd}+.*?\}'
ROBUST_TOTAL = r'\{[^{}]*"total_score"[^{}]*\}'

# --- Fixed values: score fields and their ranges, in checking order ---
SCORE_RANGES = {
    "correctness": (0, 50),
    "logic": (0, 25),
    "clarity": (0, 15),
    "completeness": (0, 10),
    "total_score": (0, 100),
}
DIMENSIONS = ("correctness", "logic", "clarity", "completeness")
NO_SCORE_STRICT = "Unable to extract score JSON"
NO_SCORE_ROBUST = "Failed to extract score JSON"
MISSING_FIELD = "Missing field: {name}"
NOT_A_NUMBER = "{name} is not a number"
OUT_OF_RANGE = "{name} out of range"
SEEN_VALUE = ": "
RANGE_AND_VALUE = " [{low}, {high}]: "
BAD_LINE = "JSON parse error"

# --- Fixed values: report bins, percentiles, verdict thresholds ---
SPREAD_EDGES = (0, 5, 10, 15, 20, 25, 30, 40, 50, 100)
SPREAD_PERCENTILES = (25, 50, 75, 90, 95, 99)
GRADE_EDGES = (0, 50, 60, 70, 80, 90, 100)
GRADE_LABELS = (
    "Fail (<50)",
    "Pass (50-59)",
    "Good (60-69)",
    "Good+ (70-79)",
    "Excellent (80-89)",
    "Excellent+ (90-100)",
)
LOW_SPREAD, MODERATE_SPREAD, TIGHT_P75 = 10, 20, 15
PREVIEW_CHARS = 200

# --- Fixed values: inference defaults ---
RETRY_STATUSES = (429, 500, 502, 503, 504)
OPTIONAL_PARAMS = (
    "stop",
    "stop_token_ids",
    "repetition_penalty",
    "frequency_penalty",
    "presence_penalty",
    "min_new_tokens",
)
ROW_PARAMS = ("temperature", "max_tokens", "top_p", "stop", "frequency_penalty")
MAX_RETRIES = 500
JUDGE_PARAMS = {"temperature": 0.3, "max_tokens": 2048}
STAGE1_PARAMS = {"temperature": 1.0, "top_p": 0.95, "max_new_tokens": 32768}
STAGE2_PARAMS = {"temperature": 0.2, "top_p": 0.95, "max_new_tokens": 32768}
MIN_LENGTH_RATIO, MIN_LENGTH_FLOOR = 0.9, 120
CSV_COLUMNS = (
    "sample_idx",
    "output_name",
    "correctness",
    "logic",
    "clarity",
    "completeness",
    "total_score",
    "brief_comment",
)
