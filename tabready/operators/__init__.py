"""DataFrame-to-DataFrame operators, by SURVEY section 2 ID.

- ``target``: P10 target build, A2 readiness, F1-F6 filters, funnel and gate,
  A6 statistics, A7 value counts.
- ``features``: P3 synthetic identifier, P11 engineered features, P12 model
  projection, and the P4-P8 cleaning stage.
- ``dedup``: W1 most-complete de-duplication, A3/A4 duplicate counts.
- ``split``: M1-M3 split, sample and resplit; J5, U1, U2, U5 checks; A5 summary.
- ``quantiles``: bounded exact quantiles used by A2, A5, A6, A11 and L1.
- ``profile``: A1 profile, F14 contract draft, A8-A11 insights, F12 sparse features.
- ``metrics``: A12/A13 metrics, P14 residuals, J6 alignment, C3 grid.
- ``leaderboard``: W2-W10 ranks, top-k and importance scaling.
- ``candidates``: closed-form candidates (L5 and the SQL-checkable models).
- ``train``: L1-L4 imputation and encoding, L6-L9 pyspark.ml search, blend, scoring.
- ``importance``: L10 permutation importance, L11 model importance.
- ``compare``: J2-J4, U3, L15, L16 cross-run comparison and recommendation.
- ``gates``: F8, F9, F17, Q1-Q3 checks over result tables.
"""
