"""They must equal the monitored service's own for results to match."""

# Defaults for missing fields.
UNTITLED = "Untitled"
UNKNOWN_JOURNAL = "Unknown Journal"

# Labels in a bilingual response, the anchor format and the link pattern.
ENGLISH_LABEL = "English:"
HEBREW_LABEL = "Hebrew:"
ANCHOR_PREFIX = "art-"
ANCHOR_LINK_PATTERN = r"href=['\"]#(art-\d+)['\"]"
FIRST_CURSOR = "*"

# Error codes after which an article request is tried again.
RETRYABLE_CODES = ("503", "429")

# Texts that stand in for a missing summary, per tier.
NO_ABSTRACT = ("Abstract unavailable.", "תקציר אינו זמין.")
ARTICLE_UNLABELLED_HE = "תרגום עברי לא הופק כנדרש."
ARTICLE_FAILED = ("Error producing summary.", "שגיאה בהפקת התקציר.")
ARTICLE_EXHAUSTED = ("Summary skipped.", "תקציר דולג עקב עומס שרת.")
DOMAIN_UNLABELLED_HE = "סיכום מנהלים בעברית אינו זמין."
DOMAIN_EXHAUSTED = ("Overview synthesis unavailable.", "סיכום מנהלים אינו זמין זמנית.")
GLOBAL_UNLABELLED_HE = "לקט מנהלים עברי אינו זמין זמנית."
GLOBAL_EXHAUSTED = ("Global trends summary unavailable.", "תקציר מגמות אינו זמין.")

# The characters that whitespace stripping removes (Unicode White_Space and the
# four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_PATTERN = r"(?U)[\s\x1c-\x1f]+"
