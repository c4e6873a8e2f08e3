"""Word lists, lookup tables and patterns.

Everything here must keep exactly these values for results to be comparable, so each table is stated
plainly, in its natural order, and holds no logic.
"""

# Contraction -> expansion.
CONTRACTIONS = {
    "can't": "cannot", "won't": "will not", "n't": " not",
    "i'm": "i am",
    "it's": "it is", "he's": "he is", "she's": "she is", "that's": "that is", "what's": "what is",
    "there's": "there is", "let's": "let us",
    "you're": "you are", "they're": "they are", "we're": "we are",
    "i've": "i have", "you've": "you have", "we've": "we have", "they've": "they have",
    "i'll": "i will", "you'll": "you will", "he'll": "he will", "she'll": "she will",
    "we'll": "we will", "they'll": "they will",
    "i'd": "i would", "you'd": "you would", "he'd": "he would", "she'd": "she would",
    "we'd": "we would", "they'd": "they would",
}

# Slang token -> replacement.
SLANG = {
    "lol": "laughing", "lmao": "laughing", "rofl": "laughing", "brb": "be right back",
    "idk": "i do not know", "imo": "in my opinion", "imho": "in my humble opinion",
    "btw": "by the way", "thx": "thanks", "u": "you", "ur": "your", "gr8": "great", "b4": "before",
    "pls": "please",
}

# Negation words (the apostrophe is U+2019).
NEGATIONS = (
    "barely can’t couldn’t didn’t doesn’t don’t hardly isn’t mustn’t neither never no nobody none "
    "not nothing nowhere scarcely shouldn’t wasn’t weren’t won’t wouldn’t"
).split()

# Contrastive connectives and sentence ends.
CONNECTIVES = (
    "but however though although yet still whereas nonetheless nevertheless"
).split()
SENTENCE_ENDS = [".", "!", "?"]

# The classical English stop-word list.
STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at "
    "by for with about against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn "
    "doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Penn tag initial -> WordNet class; anything else is a noun.
WORDNET_CLASSES = {"J": "a", "V": "v", "N": "n", "R": "r"}

# WordNet detachment rules, (class, suffix, replacement).
DETACHMENT_RULES = [
    ("n", "s", ""), ("n", "ses", "s"), ("n", "ves", "f"), ("n", "xes", "x"), ("n", "zes", "z"),
    ("n", "ches", "ch"), ("n", "shes", "sh"), ("n", "men", "man"), ("n", "ies", "y"),
    ("v", "s", ""), ("v", "ies", "y"), ("v", "es", "e"), ("v", "es", ""), ("v", "ed", "e"),
    ("v", "ed", ""), ("v", "ing", "e"), ("v", "ing", ""),
    ("a", "er", ""), ("a", "est", ""), ("a", "er", "e"), ("a", "est", "e"),
]

# Code points with the Unicode Emoji property outside the pictograph blocks.
EMOJI_SYMBOLS = (
    "a9 ae 203c 2049 2122 2139 2194-2199 21a9-21aa 231a-231b 2328 23cf 23e9-23f3 23f8-23fa 24c2 "
    "25aa-25ab 25b6 25c0 25fb-25fe 2600-2604 260e 2611 2614-2615 2618 261d 2620 2622-2623 2626 262a "
    "262e-262f 2638-263a 2640 2642 2648-2653 265f-2660 2663 2665-2666 2668 267b 267e-267f 2692-2697 "
    "2699 269b-269c 26a0-26a1 26a7 26aa-26ab 26b0-26b1 26bd-26be 26c4-26c5 26c8 26ce-26cf 26d1 "
    "26d3-26d4 26e9-26ea 26f0-26f5 26f7-26fa 26fd 2702 2705 2708-270d 270f 2712 2714 2716 271d 2721 "
    "2728 2733-2734 2744 2747 274c 274e 2753-2755 2757 2763-2764 2795-2797 27a1 27b0 27bf 2934-2935 "
    "2b05-2b07 2b1b-2b1c 2b50 2b55 3030 303d 3297 3299"
)
# Pictograph blocks, in which every named code point counts as an emoji.
EMOJI_BLOCKS = "1f004 1f0cf 1f170-1f171 1f17e-1f17f 1f18e 1f191-1f19a 1f1e6-1f1ff 1f300-1f3fa " \
    "1f400-1f64f 1f680-1f6ff 1f7e0-1f7eb 1f90c-1f9ff 1fa70-1faff"

# CLDR short names that differ from the character's Unicode name.
EMOJI_CLDR_NAMES = {
    "❤": "red_heart", "💙": "blue_heart", "💚": "green_heart", "💛": "yellow_heart",
    "💜": "purple_heart", "👍": "thumbs_up", "👎": "thumbs_down", "👏": "clapping_hands",
    "🙏": "folded_hands", "👌": "OK_hand", "✌": "victory_hand", "💪": "flexed_biceps",
    "🙌": "raising_hands", "👋": "waving_hand", "💯": "hundred_points", "😀": "grinning_face",
    "😁": "beaming_face_with_smiling_eyes", "😃": "grinning_face_with_big_eyes",
    "😄": "grinning_face_with_smiling_eyes", "😅": "grinning_face_with_sweat",
    "😆": "grinning_squinting_face", "😇": "smiling_face_with_halo",
    "😈": "smiling_face_with_horns", "😉": "winking_face", "😋": "face_savoring_food",
    "😍": "smiling_face_with_heart-eyes", "😎": "smiling_face_with_sunglasses",
    "😓": "downcast_face_with_sweat", "😔": "pensive_face", "😘": "face_blowing_a_kiss",
    "😙": "kissing_face_with_smiling_eyes", "😚": "kissing_face_with_closed_eyes",
    "😛": "face_with_tongue", "😜": "winking_face_with_tongue", "😝": "squinting_face_with_tongue",
    "😡": "enraged_face", "😣": "persevering_face", "😤": "face_with_steam_from_nose",
    "😥": "sad_but_relieved_face", "😧": "anguished_face", "😫": "tired_face",
    "😰": "anxious_face_with_sweat", "😱": "face_screaming_in_fear", "😳": "flushed_face",
    "😷": "face_with_medical_mask", "🙂": "slightly_smiling_face", "🙁": "slightly_frowning_face",
    "🙄": "face_with_rolling_eyes", "☺": "smiling_face", "☹": "frowning_face", "☀": "sun",
    "☁": "cloud", "☕": "hot_beverage", "✅": "check_mark_button", "✔": "check_mark",
    "❌": "cross_mark", "✊": "raised_fist", "⭐": "star", "🌟": "glowing_star", "🎉": "party_popper",
    "💔": "broken_heart", "🔥": "fire", "✨": "sparkles",
    "©": "copyright", "®": "registered", "™": "trade_mark", "🐻": "bear", "🐼": "panda", "🦊": "fox",
    "🐺": "wolf", "🦁": "lion", "🐸": "frog", "🐹": "hamster", "🦄": "unicorn", "🍕": "pizza",
    "🤗": "smiling_face_with_open_hands", "⚡": "high_voltage",
    "🎶": "musical_notes", "🏠": "house", "💃": "woman_dancing", "🕺": "man_dancing", "💦": "sweat_droplets",
    "💤": "ZZZ", "👊": "oncoming_fist", "👆": "backhand_index_pointing_up", "👇": "backhand_index_pointing_down",
    "👈": "backhand_index_pointing_left", "👉": "backhand_index_pointing_right", "🔫": "water_pistol",
    "🔴": "red_circle", "🔵": "blue_circle", "👯": "people_with_bunny_ears", "🤼": "people_wrestling",
    "🧑": "person", "🧒": "child", "🧏": "deaf_person", "🧜": "merperson", "🎅": "Santa_Claus", "🏳": "white_flag",
    "🏴": "black_flag", "👪": "family", "☠": "skull_and_crossbones", "☎": "telephone", "✈": "airplane",
    "☝": "index_pointing_up", "✏": "pencil", "❗": "red_exclamation_mark", "❓": "red_question_mark",
    "➕": "plus", "➖": "minus", "♥": "heart_suit", "🖕": "middle_finger", "🤘": "sign_of_the_horns",
    "🤞": "crossed_fingers", "🤙": "call_me_hand", "🤝": "handshake", "🤮": "face_vomiting",
    "🤯": "exploding_head", "🤬": "face_with_symbols_on_mouth", "🤩": "star-struck", "🤪": "zany_face",
    "🥰": "smiling_face_with_hearts", "🥳": "partying_face", "🥺": "pleading_face", "🤤": "drooling_face",
    "🤢": "nauseated_face", "🤧": "sneezing_face", "🤓": "nerd_face", "🤑": "money-mouth_face",
    "🤒": "face_with_thermometer", "🤕": "face_with_head-bandage",
}
# Skin-tone suffixes for U+1F3FB to U+1F3FF.
SKIN_TONES = [
    "light_skin_tone", "medium-light_skin_tone", "medium_skin_tone", "medium-dark_skin_tone",
    "dark_skin_tone",
]

# Irregular forms and their lemmas by word class, English.
IRREGULAR_LEMMAS = {
    "n": {
        "children": "child", "feet": "foot", "geese": "goose", "men": "man", "mice": "mouse", "oxen": "ox",
        "teeth": "tooth", "women": "woman", "wives": "wife", "lives": "life", "knives": "knife", "leaves": "leaf",
    },
    "v": {
        "am": "be", "are": "be", "is": "be", "was": "be", "were": "be", "been": "be", "has": "have", "had": "have",
        "does": "do", "did": "do", "done": "do", "went": "go", "gone": "go", "said": "say", "made": "make",
        "took": "take", "taken": "take", "got": "get", "came": "come", "saw": "see", "seen": "see", "knew": "know",
        "known": "know", "thought": "think", "gave": "give", "given": "give", "found": "find", "told": "tell",
        "felt": "feel", "left": "leave", "bought": "buy", "brought": "bring", "kept": "keep", "began": "begin",
    },
    "a": {"better": "good", "best": "good", "worse": "bad", "worst": "bad"},
    "r": {"better": "well", "best": "well", "worse": "badly", "worst": "badly"},
}

# What a person does in an emoji that has a neutral, a female and a male form.
EMOJI_ACTIONS = {
    "⛹": "bouncing_ball", "🏃": "running", "🏄": "surfing", "🏊": "swimming", "🏋": "lifting_weights",
    "🏌": "golfing", "👰": "with_veil", "👱": "blond_hair", "👳": "wearing_turban", "💆": "getting_massage",
    "💇": "getting_haircut", "🙅": "gesturing_NO", "🙆": "gesturing_OK", "🙇": "bowing", "🙋": "raising_hand", "💁": "tipping_hand",
    "🙍": "frowning", "🙎": "pouting", "🚣": "rowing_boat", "🚴": "biking", "🚵": "mountain_biking",
    "🚶": "walking", "🤦": "facepalming", "🤵": "in_tuxedo", "🤷": "shrugging", "🤸": "cartwheeling",
    "🤹": "juggling", "🤽": "playing_water_polo", "🤾": "playing_handball", "🧍": "standing", "🧎": "kneeling",
    "🧔": "beard", "🧖": "in_steamy_room", "🧗": "climbing", "🧘": "in_lotus_position",
}
# Roles whose neutral form names no person.
EMOJI_ROLES = {
    "👮": "police_officer", "👷": "construction_worker", "💂": "guard", "🕵": "detective", "🦸": "superhero",
    "🦹": "supervillain", "🧙": "mage", "🧚": "fairy", "🧛": "vampire", "🧝": "elf", "🧞": "genie", "🧟": "zombie",
}
# Objects that a man, a woman or a person is joined with, and the role or state they stand for.
EMOJI_PROFESSIONS = {
    "⚕": "health_worker", "⚖": "judge", "✈": "pilot", "🌾": "farmer", "🍳": "cook", "🎓": "student",
    "🎤": "singer", "🎨": "artist", "🏫": "teacher", "🏭": "factory_worker", "💻": "technologist",
    "💼": "office_worker", "🔧": "mechanic", "🔬": "scientist", "🚀": "astronaut", "🚒": "firefighter",
}
EMOJI_STATES = {
    "🍼": "feeding_baby", "🦯": "with_white_cane", "🦼": "in_motorized_wheelchair", "🦽": "in_manual_wheelchair",
}
EMOJI_HAIR = {"🦰": "red_hair", "🦱": "curly_hair", "🦲": "bald", "🦳": "white_hair"}
# Joined emoji that follow no rule; code points in order, without joiners and variation selectors.
EMOJI_JOINED = {
    "🏳🌈": "rainbow_flag", "🏳⚧": "transgender_flag", "🏴☠": "pirate_flag", "👁🗨": "eye_in_speech_bubble",
    "🐕🦺": "service_dog", "🐈⬛": "black_cat", "🐻❄": "polar_bear", "🐦⬛": "black_bird", "🐦🔥": "phoenix",
    "🍋🟩": "lime", "🍄🟫": "brown_mushroom", "❤🔥": "heart_on_fire", "❤🩹": "mending_heart",
    "😮💨": "face_exhaling", "😵💫": "face_with_spiral_eyes", "😶🌫": "face_in_clouds", "⛓💥": "broken_chain",
    "🙂↔": "head_shaking_horizontally", "🙂↕": "head_shaking_vertically", "🧑🎄": "mx_claus",
    "👯♀": "women_with_bunny_ears", "👯♂": "men_with_bunny_ears", "🤼♀": "women_wrestling", "🤼♂": "men_wrestling",
    "🧏♀": "deaf_woman", "🧏♂": "deaf_man", "🧜♀": "mermaid", "🧜♂": "merman", "🫱🫲": "handshake",
    "👩🤝👨": "woman_and_man_holding_hands", "👨🤝👨": "men_holding_hands", "👩🤝👩": "women_holding_hands",
    "🧑🤝🧑": "people_holding_hands", "🧑🧑🧒": "family_adult_adult_child",
    "🧑🧑🧒🧒": "family_adult_adult_child_child", "🧑🧒": "family_adult_child",
    "🧑🧒🧒": "family_adult_child_child",
}
# Flags of parts of a country, by their tag letters.
EMOJI_PART_FLAGS = {"gbeng": "England", "gbsct": "Scotland", "gbwls": "Wales"}
# Region codes that have a name but no flag (withdrawn, private or grouping codes).
REGIONS_WITHOUT_FLAG = "AN BU CS DD DY EZ FX HV NH QO RH SU TP UK VD XA XB YD YU ZR ZZ"
