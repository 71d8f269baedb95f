"""These decide results, so they are stated literally and kept together."""

# Class order: position is the class id.
EMOTIONS = ["sadness", "joy", "love", "anger", "fear", "surprise"]

# Class shown for a text with no token left after cleaning.
UNKNOWN = "unknown"
UNKNOWN_ID = -1

# Emoticon -> word, in this order; cleaning applies longer ones first.
EMOTICONS = [
    (":)", "happy"), (":-)", "happy"), ("=)", "happy"),
    (":D", "laughing"), (":-D", "laughing"),
    (":(", "sad"), (":-(", "sad"), ("=(", "sad"),
    (":'(", "crying"), (";(", "crying"),
    (">:(", "angry"), (">:-(", "angry"),
    (":o", "surprised"), (":-o", "surprised"),
    (":p", "playful"), (":-p", "playful"),
    (":-/", "confused"), (":/", "confused"),
    ("<3", "love"), ("</3", "heartbroken"),
    ("xd", "laughing"),
]

# Code point ranges replaced by a space.
SYMBOL_RANGES = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2500}-\x{2BEF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}"
)

# Unicode white space as a character-class body. A bare \s is ASCII only, in Java and in RE2 alike.
WHITE_SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"

URL = rf"https?://[^{WHITE_SPACE}]+|www\.[^{WHITE_SPACE}]+"
TAG = r"<[^>]+>"
FEATURE_TOKEN = r"\b[a-z][a-z]+\b"

# Line ends of a pasted text.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"

# Words split in two by the word tokeniser: (first half, second half).
TWO_PART_WORDS = [
    ("can", "not"), ("d", "'ye"), ("gim", "me"), ("gon", "na"),
    ("got", "ta"), ("lem", "me"), ("more", "'n"),
]

# Negation and degree words that are never dropped.
PRESERVED_WORDS = ["not", "no", "nor", "very", "too", "more", "most", "never"]

# The public English stop-word list (179 words), in its usual order.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Inflection suffix -> base suffix.
VERB_SUFFIXES = [
    ("s", ""), ("ies", "y"), ("es", "e"), ("es", ""),
    ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
]
NOUN_SUFFIXES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]

# Irregular form -> base form.
IRREGULAR_FORMS = dict(
    pair.split(":") for pair in """
am:be are:be is:be was:be were:be been:be has:have had:have did:do done:do went:go gone:go
said:say made:make took:take taken:take came:come saw:see seen:see knew:know known:know got:get
gotten:get gave:give given:give found:find thought:think told:tell became:become left:leave felt:feel
brought:bring began:begin begun:begin kept:keep held:hold wrote:write written:write stood:stand
heard:hear meant:mean met:meet paid:pay sat:sit spoke:speak spoken:speak led:lead grew:grow grown:grow
lost:lose fell:fall fallen:fall sent:send built:build understood:understand drew:draw drawn:draw
broke:break broken:break spent:spend rose:rise risen:rise drove:drive driven:drive bought:buy wore:wear
worn:wear chose:choose chosen:choose ate:eat eaten:eat slept:sleep wept:weep hid:hide hidden:hide
fought:fight caught:catch taught:teach sold:sell won:win forgot:forget forgotten:forget woke:wake
sang:sing sung:sing swam:swim threw:throw thrown:throw tore:tear torn:tear shook:shake shaken:shake
children:child feet:foot teeth:tooth mice:mouse geese:goose people:people lives:life wives:wife
knives:knife leaves:leaf
""".split())

# Vectoriser defaults.
MAX_FEATURES = 50_000
NGRAM_RANGE = (1, 2)
MIN_DF = 2
MAX_DF = "0.95"

# Embedding defaults.
VECTOR_SIZE = 200
WINDOW = 5
MIN_COUNT = 2
EPOCHS = 15

SEED = 42

# Split shares, as decimal text so that every engine rounds them alike.
TEST_SIZE = "0.20"
VAL_SIZE = "0.10"
HOLDOUT_SIZE = "0.10"
FOLDS = 5

# Hyper-parameter grids.
GRIDS = {
    "svm": {"C": [0.1, 1.0, 5.0, 10.0]},
    # Spark's trees end at depth 30, which stands for unlimited and for 40.
    "rf": {"numTrees": [100, 200, 300], "maxDepth": [30, 20], "minSplit": [2, 5]},
    "gb": {"maxIter": [100, 150], "stepSize": [0.05, 0.1, 0.2], "maxDepth": [3, 5]},
    "mlp": {},
    "cnb": {"alpha": [0.1, 0.5, 1.0]},
}
SWEEP_HIDDEN = [64, 128]
SWEEP_ITERATIONS = [50, 100]

TOP_WORDS = 80
LENGTH_BINS = 40
PREVIEW_CHARS = 80
GOOD_F1 = 0.70
