"""quartermart: layered travel analytics as composable Spark DataFrame operators.

Layers (each a pure DataFrame -> DataFrame function, no actions):

* ``sources``    raw CSV scans, table sinks, the test-data binding
* ``functions``  Column builders: ordered rules, ratios, labels, map helpers
* ``operators``  reusable DataFrame operators: cleaning, dimension joins,
                 ranking, growth, quality profiles
* ``plans``      the warehouse jobs: POI and visit cleaning, the three
                 quarterly marts, the user portrait and the leaderboards
"""

from quartermart.plans.poi import clean_poi
from quartermart.plans.visits import clean_visits
from quartermart.plans.user_quarter import user_quarter
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import city_quarter
from quartermart.plans.portrait import user_portrait
from quartermart.plans.leaderboards import top_attractions, top_cities

__all__ = [
    "clean_poi",
    "clean_visits",
    "user_quarter",
    "attraction_quarter",
    "city_quarter",
    "user_portrait",
    "top_attractions",
    "top_cities",
]
