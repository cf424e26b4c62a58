"""Silver layer: one cleaning function per bronze table."""

from courierlake.plans.silver.billing import clean_billing
from courierlake.plans.silver.customers import clean_customers
from courierlake.plans.silver.delivery import clean_delivery
from courierlake.plans.silver.drivers import clean_drivers
from courierlake.plans.silver.orders import clean_orders
from courierlake.plans.silver.payments import clean_payments
from courierlake.plans.silver.promotions import clean_promotions
from courierlake.plans.silver.restaurants import clean_restaurants
from courierlake.plans.silver.reviews import clean_reviews
from courierlake.plans.silver.users import clean_users

SILVER = {
    "orders": clean_orders,
    "payments": clean_payments,
    "delivery": clean_delivery,
    "billing": clean_billing,
    "customers": clean_customers,
    "users": clean_users,
    "restaurants": clean_restaurants,
    "drivers": clean_drivers,
    "promotions": clean_promotions,
    "reviews": clean_reviews,
}
