"""Text that appears in results. Dashboards and reports match on them."""

DIFFUSE = "diffus"
NONE_PRESENT = "—"
NATIONAL = "US"

ZONE_CONCENTRATED = "point noir concentré"
ZONE_DIFFUSE = "réseau étendu (volume diffus)"
ZONE_UNKNOWN = "n/d (hors top OSM)"
ZONE_NO_EXPOSURE = "n/d (pas d'exposition)"

EVENT_YEAR_END = "Noël / Nouvel An"
EVENT_THANKSGIVING = "Sem. Thanksgiving"
EVENT_JULY_4 = "4 Juillet"
EVENT_MEMORIAL = "Memorial Day (approx.)"
EVENT_NORMAL = "Période normale"

# Wording of the written plan.
PLAN_WORDING = {
    "traffic_signal": "installer des feux",
    "crossing": "sécuriser passage piéton",
    "stop": "stop / cédez-le-passage",
    "traffic_calming": "modération de trafic (ralentisseurs)",
    "railway": "sécuriser le passage à niveau (barrières/feux)",
    "diffuse": "investiguer facteur humain (vitesse / contrôle)",
    "equipped": "déjà équipé — revoir géométrie / abords",
}

# Wording of the batch job's table.
JOB_WORDING = {
    "traffic_signal": "installer des feux",
    "crossing": "sécuriser passage piéton",
    "stop": "stop / cédez-le-passage",
    "traffic_calming": "modération de trafic",
    "railway": "sécuriser le passage à niveau",
    "diffuse": "investiguer facteur humain",
    "equipped": "déjà équipé - revoir géométrie",
}

# Wording of the interactive plan.
SCREEN_WORDING = {
    "traffic_signal": "Installer des feux",
    "crossing": "Sécuriser un passage piéton",
    "stop": "Poser stop / cédez-le-passage",
    "traffic_calming": "Modération de trafic (ralentisseurs)",
    "railway": "Sécuriser le passage à niveau",
    "diffuse": "Investiguer facteur humain (vitesse/contrôles)",
    "equipped": "Déjà équipé - étude géométrie/abords",
}

ELEMENT_NAMES = {
    "junction": "carrefour", "crossing": "passage piéton", "stop": "stop",
    "traffic_signal": "feux", "railway": "passage à niveau", "station": "station",
    "roundabout": "rond-point", "bump": "dos d'âne", "give_way": "cédez-le-passage",
    "no_exit": "impasse", "traffic_calming": "modération trafic",
    "amenity": "équipement public",
}
