"""Word lists that results depend on."""

from __future__ import annotations

# fixed values: spelling variants and the label they stand for
ALIASES = {
    "hip hop": "hip-hop", "hiphop": "hip-hop", "rap": "hip-hop", "trap": "hip-hop", "r&b": "rnb", "r & b": "rnb", "rhythm and blues": "rnb",
    "edm": "electronic", "dance": "electronic", "electronica": "electronic", "house": "electronic", "indie rock": "indie", "indie pop": "indie",
    "kpop": "k-pop", "k pop": "k-pop", "alternative rock": "alternative", "alt rock": "alternative",
}

# fixed values: the buckets, order is priority
BUCKETS = [
    "pop", "k-pop", "j-pop", "c-pop", "mandopop", "cantopop", "city pop", "indie pop", "art pop", "synth-pop", "electropop", "dance-pop", "rock", "classic rock",
    "hard rock", "indie rock", "alternative rock", "alternative", "psychedelic rock", "progressive rock", "post-rock", "shoegaze", "grunge", "britpop", "folk rock",
    "country rock", "blues rock", "punk", "punk rock", "pop punk", "post-punk", "hardcore punk", "ska punk", "emo", "metal", "heavy metal", "black metal", "death metal",
    "thrash metal", "doom metal", "power metal", "nu metal", "metalcore", "folk metal", "grindcore", "hip-hop", "trap", "drill", "grime", "boom bap", "gangsta rap",
    "cloud rap", "r&b", "soul", "neo soul", "funk", "motown", "electronic", "house", "deep house", "techno", "trance", "dubstep", "drum and bass", "jungle", "garage",
    "electro", "synthwave", "vaporwave", "downtempo", "chillout", "edm", "industrial", "new wave", "hardstyle", "glitch", "ambient", "new age", "drone", "noise",
    "experimental", "avant-garde", "jazz", "swing", "bebop", "smooth jazz", "free jazz", "fusion", "big band", "latin jazz", "acid jazz", "nu jazz", "blues",
    "delta blues", "chicago blues", "country", "bluegrass", "americana", "singer-songwriter", "folk", "celtic", "klezmer", "classical", "baroque", "romantic", "opera",
    "chamber music", "symphony", "choral", "contemporary classical", "reggae", "dancehall", "ska", "dub", "soca", "reggaeton", "latin", "salsa", "merengue", "bachata",
    "cumbia", "tango", "bossa nova", "samba", "flamenco", "mariachi", "ranchera", "latin pop", "latin trap", "afrobeat", "afrobeats", "highlife", "soukous", "amapiano",
    "kwaito", "gqom", "bhangra", "qawwali", "hindustani classical", "carnatic classical", "bollywood", "gospel", "christian", "disco", "funk carioca", "world",
    "spoken word", "soundtrack", "musical theatre", "other",
]

# fixed values: keyword rules (keyword, bucket), order is priority
KEYWORDS = [
    ("hip hop", "hip-hop"), ("hiphop", "hip-hop"), ("rap", "hip-hop"), ("trap", "trap"), ("drill", "drill"), ("grime", "grime"), ("r&b", "r&b"), ("rnb", "r&b"),
    ("soul", "soul"), ("funk", "funk"), ("hous", "electronic"), ("techno", "electronic"), ("trance", "electronic"), ("dubstep", "electronic"), ("garage", "electronic"),
    ("jungle", "electronic"), ("breakbeat", "electronic"), ("electro", "electronic"), ("synth", "electronic"), ("edm", "electronic"), ("bass", "electronic"),
    ("core", "electronic"), ("metal", "metal"), ("punk", "punk"), ("emo", "emo"), ("rock", "rock"), ("grunge", "grunge"), ("jazz", "jazz"), ("blues", "blues"),
    ("country", "country"), ("bluegrass", "bluegrass"), ("folk", "folk"), ("americana", "americana"), ("classical", "classical"), ("baroque", "baroque"),
    ("opera", "opera"), ("symphon", "classical"), ("chant", "classical"), ("cantata", "classical"), ("sonata", "classical"), ("concerto", "classical"),
    ("choral", "classical"), ("reggae", "reggae"), ("dancehall", "dancehall"), ("ska", "ska"), ("dub", "dub"), ("soca", "soca"), ("calypso", "calypso"),
    ("reggaeton", "reggaeton"), ("salsa", "salsa"), ("merengue", "merengue"), ("bachata", "bachata"), ("cumbia", "cumbia"), ("tango", "tango"), ("samba", "samba"),
    ("flamenco", "flamenco"), ("mariachi", "mariachi"), ("ranchera", "ranchera"), ("latin", "latin"), ("afrobeat", "afrobeat"), ("afro", "afrobeats"),
    ("highlife", "highlife"), ("amapiano", "amapiano"), ("kwaito", "kwaito"), ("gospel", "gospel"), ("christian", "christian"), ("worship", "worship"),
    ("disco", "disco"), ("gamelan", "gamelan"), ("bollywood", "bollywood"), ("bhangra", "bhangra"), ("qawwali", "qawwali"), ("carnatic", "carnatic classical"),
    ("hindustani", "hindustani classical"), ("k-pop", "k-pop"), ("kpop", "k-pop"), ("j-pop", "j-pop"), ("jpop", "j-pop"), ("c-pop", "c-pop"), ("mandopop", "mandopop"),
    ("cantopop", "cantopop"), ("pop", "pop"), ("ambient", "ambient"), ("new age", "new age"), ("noise", "noise"), ("experimental", "experimental"),
    ("avant-garde", "avant-garde"), ("chant", "classical"), ("comedy", "comedy"), ("spoken word", "spoken word"), ("poetry", "poetry"), ("soundtrack", "soundtrack"),
    ("musical", "musical theatre"), ("children", "children's music"), ("video game", "video game music"),
]

OTHER = "other"
#: The MD5 of an empty file, which some picture services use as the name of "no picture".
EMPTY_PICTURE = "d41d8cd98f00b204e9800998ecf8427e"
