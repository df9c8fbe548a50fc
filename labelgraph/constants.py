"""Fixed values and defaults.

The block marked FIXED VALUES holds strings and numbers that must equal the original
pipeline's output byte for byte (question wording, chat markers, id formats, error codes,
label keys). They are stated once here, plainly, and used everywhere else by name.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's output; do not reword)
# ---------------------------------------------------------------------------------------
Q_CONCEPT = "What is the ontological concept '{name}'?"
Q_PARENT = "What is the parent of the concept '{name}'?"
Q_CHILDREN = "What are the children of the concept '{name}'?"
EXAMPLE_PREFIX = "Example: "
EXAMPLE_MARKER = "example:"
PARAGRAPH_SEP = "\n\n"
HUMAN_TURN = "<image>\nClassify this learning material using the provided ontology."
HUMAN_ROLE = "human"
ASSISTANT_ROLE = "gpt"
SAMPLE_ID_FORMAT = "sample_%06d"
FRAME_FILE_FORMAT = "frame_%d.jpg"
PAGE_FILE_FORMAT = "page_%d.png"
LABEL_KEYS = ("Areas", "Scopes", "Abilities")
LABEL_KEYS_SINGULAR = ("Area", "Scope", "Ability")
DIM_NAMES = ("Area", "Scope", "Ability")
ERROR_CODES = ("NotLearningMaterial", "NotMathMaterial", "AreaNotCovered")
MIN_COUNTS = {"Area": 1, "Scope": 3, "Ability": 1}
IGNORE_INDEX = -100
MAX_LENGTH = 512
FRAME_INTERVAL = 150
TEST_SAMPLES = 30
EVAL_FRACTION = 0.1
ASSISTANT_MARKER = "assistant\n"
# chat layout of the model family used by the original pipeline (public chat template)
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
IMAGE_PLACEHOLDER = "<|vision_start|><|image_pad|><|vision_end|>"
DEFAULT_SYSTEM = "You are a helpful assistant."
# characters Python's str.strip()/str.split() treat as whitespace: built by rule below
# ---------------------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------------------

PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
DEFAULT_SEED = "42"
PAD_TOKEN = "<pad>"
PAD_ID = 0


# Strides for hash-drawn permutations (raft distractors): powers of a prime above any number of
# concepts are coprime with it, so j -> (b + j*a) mod C visits C distinct slots.
STRIDE_PRIME = 2**61 - 1
STRIDES = 4
