"""Explicit schemas of the landed JSON payloads.

Every landed line is one response plus a ``request`` struct with the parameters it
was fetched with, and the time of the answer (``at``): of answers that hold the same thing
the newest counts. Field names are those of the payloads (fixed values).
"""

from __future__ import annotations

_NAMED = "struct<id:bigint,name:string>"
_CODED = "struct<code:string,description:string>"
_PERSON = "struct<id:bigint,fullName:string>"
_POSITION = "struct<code:string,name:string,type:string,abbreviation:string>"
_REQUEST = "request struct<season:int,gamePk:bigint,teamId:bigint,sportId:int,awardId:string,group:string,at:timestamp>"

_TEAM_SIDE = f"struct<team:{_NAMED},score:int,isWinner:boolean>"

SCHEDULE = f"""
{_REQUEST},
dates array<struct<games:array<struct<
  gamePk:bigint, season:string, gameType:string, gameDate:timestamp, officialDate:string,
  status:struct<abstractGameState:string,codedGameState:string,detailedState:string,statusCode:string,startTimeTBD:boolean,abstractGameCode:string>,
  teams:struct<home:{_TEAM_SIDE},away:{_TEAM_SIDE}>,
  venue:struct<id:bigint,name:string>,
  isTie:boolean, gameNumber:int, publicFacing:boolean, doubleHeader:string, dayNight:string,
  scheduledInnings:int, gamesInSeries:int, seriesGameNumber:int, seriesDescription:string>>>>
"""

_PITCH_DATA = """struct<
  startSpeed:double,endSpeed:double,plateTime:double,extension:double,
  coordinates:struct<pX:double,pZ:double,x0:double,y0:double,z0:double,vX0:double,vY0:double,vZ0:double,
    aX:double,aY:double,aZ:double,pfxX:double,pfxZ:double,x:double,y:double>,
  breaks:struct<breakAngle:double,breakLength:double,breakY:double,breakVertical:double,
    breakVerticalInduced:double,breakHorizontal:double,spinRate:bigint,spinDirection:bigint>,
  zone:int,strikeZoneTop:double,strikeZoneBottom:double,strikeZoneWidth:double,strikeZoneDepth:double,
  typeConfidence:double,
  strikeZoneInfo:struct<isStrike:boolean,strikeZoneTop:double,strikeZoneBottom:double,widthInches:double,
    depthInches:double,edgeDistance:double,baseballDiameterInches:double,plateX:double,plateY:double,plateZ:double>>"""

_PLAY_EVENT = f"""struct<
  playId:string,pfxId:string,pitchNumber:int,index:int,startTime:timestamp,endTime:timestamp,type:string,isPitch:boolean,
  details:struct<code:string,description:string,call:{_CODED},ballColor:string,trailColor:string,isInPlay:boolean,
    isStrike:boolean,isBall:boolean,isOut:boolean,type:{_CODED},hasReview:boolean,runnerGoing:boolean,disengagementNum:int,
    violation:struct<type:string,description:string,player:struct<id:bigint>>>,
  count:struct<balls:int,strikes:int,outs:int>,
  pitchData:{_PITCH_DATA},
  hitData:struct<launchSpeed:double,launchAngle:double,totalDistance:double,trajectory:string,hardness:string,location:string,
    coordinates:struct<coordX:double,coordY:double>>,
  reviewDetails:struct<isOverturned:boolean,inProgress:boolean,reviewType:string,challengeTeamId:bigint,
    player:struct<id:bigint,fullName:string,link:string>>>"""

PLAY_BY_PLAY = f"""
{_REQUEST},
allPlays array<struct<atBatIndex:int,
  matchup:struct<batter:{_PERSON},pitcher:{_PERSON},batSide:{_CODED},pitchHand:{_CODED}>,
  result:struct<eventType:string,event:string,description:string,rbi:int>,
  playEvents:array<{_PLAY_EVENT}>>>
"""

_BATTING = (
    "struct<atBats:int,runs:int,hits:int,doubles:int,triples:int,homeRuns:int,rbi:int,baseOnBalls:int,strikeOuts:int,"
    "stolenBases:int,leftOnBase:int,avg:string,errors:int>"
)
_PITCHING = "struct<inningsPitched:string,hits:int,runs:int,earnedRuns:int,baseOnBalls:int,strikeOuts:int,homeRuns:int,era:string,errors:int>"
_FIELDING = "struct<putOuts:int,assists:int,errors:int,chances:int>"
_BOX_PLAYER = f"struct<person:{_PERSON},position:{_POSITION},stats:struct<batting:{_BATTING},pitching:{_PITCHING},fielding:{_FIELDING}>>"
_BOX_SIDE = f"struct<team:{_NAMED},players:map<string,{_BOX_PLAYER}>>"

BOX_SCORE = f"""
{_REQUEST},
teams struct<home:{_BOX_SIDE},away:{_BOX_SIDE}>,
officials array<struct<officialType:string,official:{_PERSON}>>,
info array<struct<label:string,value:string>>
"""

_DECISIONS = f"struct<winner:{_PERSON},loser:{_PERSON},save:{_PERSON}>"
_TEAM_STATS = f"struct<teamStats:struct<batting:{_BATTING},pitching:{_PITCHING}>>"

LIVE_FEED = f"""
{_REQUEST},
gameData struct<weather:struct<condition:string,temp:string,wind:string>,
  gameInfo:struct<attendance:int,firstPitch:timestamp,gameDurationMinutes:int>,
  datetime:struct<time:string,ampm:string>>,
liveData struct<decisions:{_DECISIONS},boxscore:struct<teams:struct<home:{_TEAM_STATS},away:{_TEAM_STATS}>>>
"""

LINE_SCORE = f"{_REQUEST}, decisions {_DECISIONS}"

TRANSACTIONS = f"""
{_REQUEST},
transactions array<struct<id:bigint,person:{_PERSON},fromTeam:{_NAMED},toTeam:{_NAMED},date:string,effectiveDate:string,
  resolutionDate:string,typeCode:string,typeDesc:string,description:string>>
"""

TEAMS = f"""
{_REQUEST},
teams array<struct<id:bigint,name:string,teamCode:string,fileCode:string,abbreviation:string,locationName:string,
  franchiseName:string,clubName:string,shortName:string,league:{_NAMED},division:{_NAMED},sport:{_NAMED},venue:{_NAMED},
  springVenue:struct<id:bigint>,springLeague:struct<id:bigint,name:string,abbreviation:string>,allStarStatus:string,
  active:boolean,firstYearOfPlay:string,season:int,parentOrgId:bigint,parentOrgName:string>>
"""

_DRAFT_PERSON = f"""struct<id:bigint,fullName:string,firstName:string,lastName:string,middleName:string,useName:string,useLastName:string,
  nickName:string,boxscoreName:string,nameSlug:string,nameTitle:string,nameSuffix:string,nameMatrilineal:string,pronunciation:string,
  birthDate:string,birthCity:string,birthStateProvince:string,birthCountry:string,deathDate:string,deathCity:string,
  deathStateProvince:string,deathCountry:string,gender:string,height:string,weight:int,strikeZoneTop:double,strikeZoneBottom:double,
  batSide:{_CODED},pitchHand:{_CODED},primaryNumber:string,active:boolean,isPlayer:boolean,isVerified:boolean,mlbDebutDate:string,
  lastPlayedDate:string,draftYear:string,currentAge:int,primaryPosition:{_POSITION},link:string>"""

DRAFT = f"""
{_REQUEST},
drafts struct<rounds:array<struct<picks:array<struct<
  bisPlayerId:bigint,pickRound:string,pickNumber:int,roundPickNumber:int,rank:int,pickValue:string,signingBonus:string,
  home:struct<city:string,state:string,country:string>,headshotLink:string,person:{_DRAFT_PERSON},
  team:struct<id:bigint,name:string,link:string,allStarStatus:string,
    springLeague:struct<id:bigint,name:string,abbreviation:string,link:string>>,
  school:struct<name:string,city:string,state:string,country:string,schoolClass:string>,
  draftType:{_CODED}>>>>>
"""

_EDUCATION = "struct<highschools:array<struct<name:string,city:string,state:string>>,colleges:array<struct<name:string,city:string,state:string>>>"

PEOPLE = f"""
{_REQUEST},
people array<struct<id:bigint,fullName:string,firstName:string,lastName:string,birthDate:string,birthCity:string,
  birthStateProvince:string,birthCountry:string,deathDate:string,isPlayer:boolean,active:boolean,
  height:string,weight:int,primaryNumber:string,primaryPosition:{_POSITION},batSide:{_CODED},pitchHand:{_CODED},
  draftYear:int,mlbDebutDate:string,lastPlayedDate:string,education:{_EDUCATION}>>
"""

AWARDS = f"""
{_REQUEST},
awards array<struct<id:string,name:string,date:string,season:string,notes:string,team:struct<id:bigint>,
  player:struct<id:bigint,nameFirstLast:string,primaryPosition:{_POSITION}>>>
"""

ROSTERS = f"""
{_REQUEST},
roster array<struct<person:{_PERSON},jerseyNumber:string,position:{_POSITION},status:{_CODED},note:string>>
"""

COACHES = f"""
{_REQUEST},
team struct<id:bigint,name:string,parentOrgId:bigint>,
roster array<struct<person:{_PERSON},jobId:string,job:string,title:string,jerseyNumber:string>>
"""

_SEASON_STAT = """struct<age:int,gamesPlayed:int,gamesStarted:int,atBats:int,runs:int,hits:int,doubles:int,triples:int,homeRuns:int,
  rbi:int,stolenBases:int,caughtStealing:int,baseOnBalls:int,strikeOuts:int,avg:string,obp:string,slg:string,ops:string,
  wins:int,losses:int,era:string,hitsPer9Inn:string,whip:string,fielding:string,gamesFinished:int,saves:int,saveOpportunities:int,
  holds:int,inningsPitched:string,earnedRuns:int,games:int,putOuts:int,assists:int,errors:int,doublePlays:int>"""

STATS = f"""
{_REQUEST},
stats array<struct<splits:array<struct<player:{_PERSON},team:{_NAMED},position:{_POSITION},stat:{_SEASON_STAT}>>>>
"""

SEASONS = f"""
{_REQUEST},
seasons array<struct<seasonId:string,hasWildcard:boolean,preSeasonStartDate:string,preSeasonEndDate:string,seasonStartDate:string,
  springStartDate:string,springEndDate:string,regularSeasonStartDate:string,lastDate1stHalf:string,allStarDate:string,
  firstDate2ndHalf:string,regularSeasonEndDate:string,postSeasonStartDate:string,postSeasonEndDate:string,seasonEndDate:string,
  offseasonStartDate:string,offSeasonEndDate:string,qualifierPlateAppearances:double,qualifierOutsPitched:double>>
"""
