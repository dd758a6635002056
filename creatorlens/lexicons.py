"""Fixed values that results depend on.

FIXED VALUES - these must stay equal to the behaviour being reproduced; they are
stated plainly, in their natural order.  Duplicates inside a list are kept as
listed; the operators deduplicate where set semantics apply.
"""

# --- FIXED VALUES: brand categories (one-hot domain of the ranking service) ---
CATEGORIES = ["beauty", "family", "fashion", "fitness", "food", "interior", "pet", "travel"]

# --- FIXED VALUES: audience keyword lexicon (143 literals, 136 distinct) ---
GENZ_KEYWORDS = [
    "genz", "mood", "vibe", "aesthetic", "sustainable", "tiktok", "viral",
    "meme", "cancelled", "woke", "squad", "lit", "fam", "goals", "af", "stan",
    "tea", "shade", "savage", "lowkey", "highkey", "flex", "clout", "yeet",
    "slay", "finsta", "snack", "ghost", "simp", "bet", "fire", "salty",
    "no cap", "goat", "sksksk", "and i oop", "fomo", "jomo", "sus", "clapback",
    "spill the tea", "bop", "cringe", "hypebeast", "drip", "big yikes",
    "oomf", "hits different", "send it", "receipts", "shook", "glow up",
    "smh", "tbh", "rn", "tysm", "irl", "nft", "crypto", "bitcoin", "blockchain",
    "influencer", "stream", "gig", "flex", "chill", "grind", "hustle",
    "iconic", "on point", "poppin", "snatched", "read", "gag", "sis", "dub",
    "L", "W", "ratioed", "on fleek", "deadass", "boujee", "thirsty", "glo up",
    "bruh", "finna", "gucci", "extra", "basic", "doxx", "swat", "ghosted",
    "slaps", "banger", "cop", "drop", "merch", "stan twitter", "main character",
    "vibe check", "weird flex", "ok boomer", "bet", "big mood", "thicc",
    "skrrt", "roasted", "dragged", "cancel culture", "bae", "fleek", "turnt",
    "ship", "OTP", "doe", "ratchet", "turn up", "squad goals", "byeee",
    "yas", "spicy", "receipts", "pressed", "orbiting", "deep dive", "fire",
    "karen", "snowflake", "troll", "woke", "cray", "chad", "simp", "emote", "kek",
    "pog", "yeet", "feels", "based", "triggered", "canceled", "blue check", "ratio",
]

# --- FIXED VALUES: audience emoji lexicon (the glued pair of the original list is
# split into its two emoji, giving 170 entries) ---
GENZ_EMOJIS = [
    "😂", "👌", "🔥", "💯", "🤔", "🥺", "✨", "🙌", "🤡", "💅", "👀", "🙈", "💖", "🌈", "😤", "😳",
    "🥴", "🤯", "😍", "🤤", "👯‍♂️", "🚀", "🎉", "🕺", "👻", "🤖", "😭", "😎", "😏", "😜", "🤩", "🫶🏽",
    "🙌", "🤌", "🫰", "💪🏾", "🙈", "🙊", "🙉", "🍃", "🩷", "💚", "🩵", "💛", "🤍", "🖤", "☺️",
    "😇", "😌", "🧐", "👽", "🤠", "👑", "🧚‍♀️", "🧜‍♀️", "🐍", "🍑", "🔮", "🎃", "👟", "🧢", "🔒",
    "🎶", "👁️", "🌟", "💌", "📌", "🧃", "🍵", "🥑", "🌮", "🌯", "🍿", "🍔", "🍕", "🍟", "🧁", "🍩",
    "🍬", "🍭", "🍮", "🍪", "🥂", "🍾", "🍷", "🍺", "🍸", "🏳️‍🌈", "🏳️‍⚧️", "🛹", "🚴‍♀️", "🧘‍♂️",
    "🏄‍♀️", "🤿", "🚣", "🎮", "👾", "🕹️", "🎤", "🎧", "📸", "💻", "📱", "🔊", "📢", "🥰", "😷",
    "🤑", "🤫", "🧠", "🤙", "👊", "✊", "🤘", "🤟", "👁️‍🗨️", "💥", "💢", "💫", "🍓", "🍉", "🥭",
    "🥦", "🧄", "🥔", "🥩", "🍳", "🥘", "🍲", "🎵", "👗", "🧵", "🛍️", "🎁", "💎", "🧸", "🚨", "🎡",
    "🏖️", "🏝️", "🌍", "🌞", "🌜", "🌛", "🌚", "🌝", "🌕", "🌖", "🌗", "🌘", "🌑", "🌒", "🌓", "🌔",
    "🍀", "🌿", "🌱", "🌵", "🌴", "🌲", "🌳", "🌺", "🌸", "🌼", "🌻", "🐾", "🦋", "🌊", "🔑", "💣",
]

# --- FIXED VALUES: audience hashtag lexicon (109 entries) ---
GENZ_HASHTAGS = [
    "#asos", "#l4l", "#instagood", "#viral", "#tiktok", "#meme", "#nofilter", "#selfcare", "#ootd",
    "#onfleek", "#blessed", "#snatched", "#yolo", "#swag", "#bae", "#squadgoals", "#fomo",
    "#adulting", "#tbh", "#tbt", "#fbf", "#lit", "#woke", "#savage", "#mood", "#vibes",
    "#thirsty", "#stan", "#flex", "#clout", "#ship", "#glowup", "#cancelculture", "#spillthetea",
    "#maincharacter", "#nft", "#crypto", "#streamerlife", "#selflove", "#hustle", "#grind",
    "#goalsaf", "#relationshipgoals", "#fitnessgoals", "#aesthetic", "#sustainable", "#ecoconscious",
    "#vegan", "#plantbased", "#foodie", "#travelgram", "#explore", "#adventure", "#digitalnomad",
    "#influencer", "#styleinspo", "#fashionista", "#beautyblogger", "#gaming", "#esports", "#fitfam",
    "#wellness", "#mindfulness", "#mentalhealthawareness", "#bodypositivity", "#activism", "#pride",
    "#loveislove", "#equality", "#blm", "#stopasianhate", "#climatechange", "#savetheplanet", "#zerowaste",
    "#minimalism", "#tinyhouse", "#vanlife", "#diy", "#art", "#handmade", "#kpop", "#anime", "#manga",
    "#netflixandchill", "#marvel", "#dccomics", "#cosplay", "#fandom", "#throwback", "#flashback",
    "#trendy", "#trending", "#hot", "#cool", "#edgy", "#hip", "#fresh", "#unique", "#rare", "#exclusive",
    "#hype", "#hypebeast", "#tech", "#geek", "#nerd", "#science", "#innovation", "#startup", "#entrepreneur",
]

# --- FIXED VALUES: title classification rules, checked in this order ---
FITNESS_KEYWORDS = [
    "Activewear", "SALE Activewear", "Gym", "Sports", "Running", "Training",
    "Ski & Snowboard", "Leggings", "Outdoors", "Yoga & Studio", "Soccer",
]
BEAUTY_KEYWORDS = [
    "Face + Body", "Makeup", "Skin care", "Body care", "Hair care", "Tools & Accessories",
    "Suncare & Tanning", "Wellness", "Skinvestments", "Caudalie", "Charlotte Tilbury",
    "COSRX", "e.l.f.", "Elemis", "ghd", "Kristin Ess Hair", "Lottie", "MAC", "Olaplex",
    "Revolution", "Sunday Riley", "The Ordinary", "SALE Face + Body",
]
DEFAULT_TITLE_CATEGORY = "fashion"

# --- FIXED VALUES: catalogue titles excluded before clustering ---
IRRELEVANT_TITLES = [
    "Men", "Home", "App and Mobile Top Level - Carousel", "List", "UP TO 50% OFF!", "Categories", "View all",
    "App & Mobile Promo", "Unlimited Next Day Delivery", "NEW PRODUCTS", "New in: Today", "Download the app!",
    "Shop By Trend", "Shop By Occasion", "SHOP BY PRODUCT", "SHOP BY BRAND", "SHOP BY TRAINER STYLE",
    "SHOP BY BAGS", "SHOP BY JEWELRY", "Browse by", "Shop by activity", "Shop by body fit", "Shop by Size",
    "Shop by Dresses", "A-Z Brands Link", "A-Z of brands", "Top Brands", "ASOS Brands", "Discover Brands",
    "View all brands", "CTAs", "CTAs New", "CTA1", "SS24 ACCESSORIES", "TRAINER CTAs", "SALE: UP TO 70% OFF",
    "Final sale", "Last chance to buy", "SALE Selling fast", "SALE View all", "Discover More", "More ASOS",
    "Unlimited express delivery", "10% Student Discount", "Gift Vouchers", "Size XS", "Size S", "Size M",
    "Size L", "Size XL", "Size XXL", "Wide Fit", "Plus Size", "Tall", "Petite", "Maternity", "Nike", "ASOS Design",
    "Columbia", "Topman", "Ape By A Bathing Ape", "Adidas", "Converse", "Dr Martens", "Vans", "UGG", "New Balance",
    "Crocs", "Puma", "Reebok", "River Island", "Jack & Jones", "Bershka", "Pull&Bear", "The North Face",
    "Tommy Hilfiger", "Stradivarius", "Miss Selfridge", "& Other Stories", "Monki", "Mango", "COLLUSION", "Topshop",
]

# --- FIXED VALUES: numeric parameters ---
ALIGNMENT_THRESHOLD = 30.0          # alignment above this collapses to 1
SERVICE_ENGAGEMENT_TARGET = 0.5     # brand engagement target of the ranking service
SCRIPT_ENGAGEMENT_TARGET = 0.4      # brand engagement target of the offline scripts
BRAND_HASHTAG_TARGET = 15.0         # brand hashtag target of the baseline ranking
TOP_K = 15                          # result size / page size
DECILE_QUANTILE = 0.9               # self-label threshold quantile
HISTOGRAM_BINS = 5
KMEANS_K = 3
KMEANS_SEED = 42
PROFILE_URL_PREFIX = "https://instagram.com/"
DEFAULT_CATEGORY = "fitness"


def title_rules() -> list[tuple[int, str, str]]:
    """The title rules as data rows ``(priority, category, keyword)``."""
    rows = [(1, "fitness", k) for k in FITNESS_KEYWORDS]
    rows += [(2, "beauty", k) for k in BEAUTY_KEYWORDS]
    return rows


def unique(seq):
    """Order-preserving de-duplication."""
    seen = set()
    out = []
    for x in seq:
        if x not in seen:
            seen.add(x)
            out.append(x)
    return out
