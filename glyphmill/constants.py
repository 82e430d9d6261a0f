"""Values that results depend on."""

# The schema version and languages of content payloads, kinds by category, words that text must not hold.
CONTENT_SCHEMA_VERSION = "content_v5_rich_en_only_api_routes"
LANGUAGES = ("en",)
CATEGORIES = ("manga", "game")
KINDS = {"manga": ("dialogue", "whisper", "shout", "narration"), "game": ("dialogue", "hud", "quest", "floating_label", "menu")}
PROVIDERS = ("fallback", "openai", "gemini", "groq")
DEFAULT_MODELS = {"openai": "gpt-4o-mini", "gemini": "gemini-2.0-flash", "groq": "llama-3.1-8b-instant"}
ACTION_WORDS = ("bam", "boom", "crash", "bang", "rumble", "rầm", "ầm", "đoàng", "đùng", "ドン", "バン", "轰", "砰", "쾅", "광")
MANGA_FORBIDDEN_TERMS = ("quest", "inventory", "hp ", "mp ", "save point", "skill unlocked")
SEED_STEP = 1009
DEFAULT_COUNT, DEFAULT_SEED = 20, 1337
BLOCKS = {"normal": 5, "dense": 12}
CANVAS = {"manga": (1024, 1440), "game": (640, 640)}
# Kinds in one cycle of a kind sequence.
KIND_CYCLE = {"manga": ("dialogue", "dialogue", "whisper", "shout", "narration"), "game": ("dialogue", "hud", "quest", "floating_label", "menu")}
# Slots of each scene style: of a normal one, and first and last count of a dense one.
DENSE_STYLES = {"hud": (16, 24), "dialogue": (10, 18), "nameplate": (14, 20), "crafting": (15, 22), "battle": (12, 22), "vendor": (12, 22), "map": (11, 21), "party": (12, 22)}
NORMAL_STYLES, NORMAL_SLOTS = ("camp", "harbor", "tower"), 5
# Weights of a freely drawn kind, in the order of KINDS.
KIND_WEIGHTS = {"manga": (5, 2, 2, 2), "game": (3, 3, 4, 2, 2)}
# Actors in a scene by style; the second table holds what dense scenes have instead. Other styles have one.
ACTORS = {"dialogue": 2, "nameplate": 3, "crafting": 2, "hud": 1, "battle": 3, "vendor": 2, "map": 1, "party": 4}
DENSE_ACTORS = {"nameplate": 5, "hud": 2}
# Textures that every panel has, and those that a coin decides.
TEXTURES, COIN_TEXTURES = ("paper_grain", "edge_shadow"), ("screentone", "hatching", "dust_scratches")
# Panels of each page layout.
NORMAL_PANELS, DENSE_PANELS = (4, 4, 5, 6, 6), (8, 7, 6, 8, 5)
