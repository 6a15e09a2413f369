"""Short forms of English given names. A user passes another dictionary through the spec."""

# Common short forms, short form -> full form.
NICKNAMES = {
    "abby": "abigail", "al": "albert", "alex": "alexander", "andy": "andrew", "angie": "angela",
    "barb": "barbara", "becky": "rebecca", "ben": "benjamin", "bernie": "bernard", "bert": "albert",
    "beth": "elizabeth", "betsy": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william",
    "bob": "robert", "bobby": "robert", "brad": "bradley", "cathy": "catherine", "charlie": "charles",
    "chris": "christopher", "chuck": "charles", "cindy": "cynthia", "dan": "daniel", "danny": "daniel",
    "dave": "david", "debbie": "deborah", "dick": "richard", "don": "donald", "doug": "douglas",
    "ed": "edward", "eddie": "edward", "fran": "frances", "fred": "frederick", "gabe": "gabriel",
    "greg": "gregory", "hank": "henry", "jack": "john", "jake": "jacob", "jeff": "jeffrey",
    "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald", "jim": "james", "jimmy": "james",
    "joe": "joseph", "johnny": "john", "jon": "jonathan", "josh": "joshua", "judy": "judith",
    "kate": "katherine", "kathy": "katherine", "ken": "kenneth", "larry": "lawrence", "liz": "elizabeth",
    "maggie": "margaret", "matt": "matthew", "meg": "margaret", "mike": "michael", "nate": "nathaniel",
    "nick": "nicholas", "pam": "pamela", "pat": "patricia", "patty": "patricia", "peggy": "margaret",
    "pete": "peter", "phil": "philip", "ray": "raymond", "rick": "richard", "rob": "robert",
    "ron": "ronald", "sam": "samuel", "sandy": "sandra", "steve": "steven", "sue": "susan",
    "ted": "theodore", "tim": "timothy", "tom": "thomas", "tommy": "thomas", "tony": "anthony",
    "vicky": "victoria", "will": "william", "zach": "zachary",
}
