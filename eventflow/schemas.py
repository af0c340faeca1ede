"""Event type names, and which raw event types make up each typed view."""

# Event type names, as the event classes are called.
ADD = "AddToShoppingCartEvent"
REMOVED = "RemovedFromShoppingCartEvent"
VIEWED = "ProductDetailsViewed"
REGISTERED = "PlayerRegistered"
ONLINE = "PlayerOnline"
OFFLINE = "PlayerOffline"

# Driver table -> typed view mapping (raw event_type -> event class).
CART_TYPES = {"purchase": ADD, "click": REMOVED}
CATALOG_TYPES = {"view": VIEWED}
SERVER_TYPES = {"signup": REGISTERED, "view": ONLINE, "error": OFFLINE}
